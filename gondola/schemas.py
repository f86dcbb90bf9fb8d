"""Schemas of the lake tables. Ids stay strings, prices are doubles."""

from __future__ import annotations

from pyspark.sql import types as T

STRING_COLUMNS = (
    "id_producto",
    "descripcion_producto",
    "marca",
    "unidad_medida",
    "id_comercio",
    "id_bandera",
    "id_sucursal",
    "nombre_comercio",
    "razon_social",
    "nombre_sucursal",
    "tipo_sucursal",
    "calle",
    "numero",
    "localidad",
    "provincia",
)
DOUBLE_COLUMNS = (
    "cantidad_presentacion",
    "latitud",
    "longitud",
    "precio_lista",
    "precio_referencia",
    "precio_promocion",
)
SILVER_COLUMNS = STRING_COLUMNS + DOUBLE_COLUMNS


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind) for kind, names in groups for name in names.split()]
    )


# ``fecha`` is the partition column of the table.
SILVER = _struct(
    (T.StringType(), " ".join(STRING_COLUMNS)),
    (T.DoubleType(), " ".join(DOUBLE_COLUMNS)),
    (T.DateType(), "fecha"),
)

DAILY_PRODUCT_PRICES = _struct(
    (T.DateType(), "fecha"),
    (T.StringType(), "id_producto descripcion_producto marca"),
    (T.DoubleType(), "precio_minimo precio_maximo"),
    (T.LongType(), "cantidad_muestras"),
    (T.DoubleType(), "precio_promedio"),
)
STORE_STATS = _struct(
    (T.DateType(), "fecha"),
    (T.StringType(), "id_comercio nombre_comercio nombre_sucursal provincia"),
    (T.LongType(), "productos_reportados"),
    (T.DoubleType(), "precio_promedio_general"),
)
PROVINCE_PRODUCT_PRICES = _struct(
    (T.DateType(), "fecha"),
    (T.StringType(), "provincia id_producto"),
    (T.DoubleType(), "precio_minimo precio_maximo"),
    (T.LongType(), "cantidad_muestras"),
    (T.DoubleType(), "precio_promedio"),
)
DAILY_INFLATION_INDEX = _struct(
    (T.DateType(), "fecha"),
    (T.LongType(), "muestras productos_distintos"),
    (
        T.DoubleType(),
        "indice_precio_global variacion_matched_pct variacion_mediana_pct variacion_media_pct",
    ),
    (T.LongType(), "productos_comparables"),
    (
        T.DoubleType(),
        "pct_productos_con_cambio indice_matched_base100 indice_global_base100 "
        "variacion_diaria_pct",
    ),
)
PRODUCT_LABELS = _struct(
    (T.StringType(), "id_producto"),
    (T.LongType(), "cantidad_muestras"),
    (T.StringType(), "descripcion_producto"),
)
PRODUCT_NUMBERS = _struct((T.StringType(), "id_producto"), (T.LongType(), "numero"))
PRODUCT_SETS = _struct(
    (T.DateType(), "fecha"), (T.LongType(), "tramo"), (T.BinaryType(), "conjunto")
)
GOLD = {
    "daily_product_prices": DAILY_PRODUCT_PRICES,
    "store_stats": STORE_STATS,
    "province_product_prices": PROVINCE_PRODUCT_PRICES,
    "daily_inflation_index": DAILY_INFLATION_INDEX,
}

QUALITY_REPORT = _struct(
    (T.StringType(), "date tipo"),
    (
        T.LongType(),
        "rows_read rows_written rows_dropped validation_failures retailers retailers_empty",
    ),
    (T.DoubleType(), "completeness_pct"),
)

CATALOGUE_PACKAGE = T.StructType(
    [
        T.StructField("success", T.BooleanType()),
        T.StructField(
            "result",
            T.StructType(
                [
                    T.StructField(
                        "resources",
                        T.ArrayType(
                            _struct((T.StringType(), "name format url last_modified created"))
                        ),
                    )
                ]
            ),
        ),
    ]
)

# One row is a batch of parsed lines of one member, so the header is not repeated per line.
ARCHIVE_ROWS = T.StructType(
    [
        T.StructField("tipo", T.StringType()),
        T.StructField("fecha", T.DateType()),
        T.StructField("archivo", T.StringType()),
        T.StructField("miembro", T.StringType()),
        T.StructField("primera_linea", T.LongType()),
        T.StructField("encabezado", T.ArrayType(T.StringType())),
        T.StructField("lineas", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)
ARCHIVE_ENTRIES = T.StructType(
    [
        T.StructField("tipo", T.StringType()),
        T.StructField("fecha", T.DateType()),
        T.StructField("ruta", T.StringType()),
        T.StructField("legible", T.BooleanType()),
        T.StructField("bytes_archivo", T.LongType()),
        T.StructField("entrada", T.StringType()),
        T.StructField("estado_entrada", T.StringType()),
        T.StructField("bytes_entrada", T.LongType()),
    ]
)
