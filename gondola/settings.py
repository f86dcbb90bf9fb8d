"""Tunable thresholds and the fixed values of the price feed."""

from __future__ import annotations

from dataclasses import dataclass

TIPOS = ("minorista", "mayorista")

# Weekday slot names of the publisher, Monday first.
WEEKDAY_SLUGS = (
    "lunes",
    "martes",
    "miercoles",
    "jueves",
    "viernes",
    "sabado",
    "domingo",
)

# The footer the publisher appends to every file, without accents.
FOOTER_PREFIX = "ultima actualizacion"
BLANK_KEYS = ("", "nan", "none")

# Texts that stand for "no value" in a cleaned column.
TEXT_PLACEHOLDERS = ("", "nan", "none", "sin marca", "s/d", "-")

# Field texts read as null by the reader (pandas' default NA tokens).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Raw column -> canonical column, in order of preference. The 0/1 flag
# ``productos_ean`` is absent on purpose: it is not a product id.
PRODUCT_COLUMNS = (
    ("id_comercio", "id_comercio"),
    ("id_bandera", "id_bandera"),
    ("id_sucursal", "id_sucursal"),
    ("id_producto", "id_producto"),
    ("productos_descripcion", "descripcion_producto"),
    ("productos_marca", "marca"),
    ("productos_cantidad_presentacion", "cantidad_presentacion"),
    ("productos_unidad_medida_presentacion", "unidad_medida"),
    ("productos_precio_lista", "precio_lista"),
    ("productos_precio_referencia", "precio_referencia"),
    ("productos_precio_unitario_promo1", "precio_promocion"),
    ("precio_unitario_bulto_por_unidad_venta_con_iva", "precio_lista"),
    ("productos_precio_unitario_con_iva_promo1", "precio_promocion"),
    ("unidad_venta", "unidad_medida"),
)
# The same for store files.
STORE_COLUMNS = (
    ("id_comercio", "id_comercio"),
    ("id_bandera", "id_bandera"),
    ("id_sucursal", "id_sucursal"),
    ("sucursales_nombre", "nombre_sucursal"),
    ("sucursales_tipo", "tipo_sucursal"),
    ("sucursales_calle", "calle"),
    ("sucursales_numero", "numero"),
    ("sucursales_localidad", "localidad"),
    ("sucursales_provincia", "provincia_codigo"),
    ("sucursales_latitud", "latitud"),
    ("sucursales_longitud", "longitud"),
)
# The same for chain files.
CHAIN_COLUMNS = (
    ("id_comercio", "id_comercio"),
    ("id_bandera", "id_bandera"),
    ("comercio_razon_social", "razon_social"),
    ("comercio_bandera_nombre", "nombre_comercio"),
)

STORE_KEYS = ("id_comercio", "id_bandera", "id_sucursal")
CHAIN_KEYS = ("id_comercio", "id_bandera")

# ISO 3166-2:AR province codes.
PROVINCE_NAMES = {
    "AR-A": "Salta",
    "AR-B": "Buenos Aires",
    "AR-C": "Ciudad Autónoma de Buenos Aires",
    "AR-D": "San Luis",
    "AR-E": "Entre Ríos",
    "AR-F": "La Rioja",
    "AR-G": "Santiago del Estero",
    "AR-H": "Chaco",
    "AR-J": "San Juan",
    "AR-K": "Catamarca",
    "AR-L": "La Pampa",
    "AR-M": "Mendoza",
    "AR-N": "Misiones",
    "AR-P": "Formosa",
    "AR-Q": "Neuquén",
    "AR-R": "Río Negro",
    "AR-S": "Santa Fe",
    "AR-T": "Tucumán",
    "AR-U": "Chubut",
    "AR-V": "Tierra del Fuego",
    "AR-W": "Corrientes",
    "AR-X": "Córdoba",
    "AR-Y": "Jujuy",
    "AR-Z": "Santa Cruz",
}

# Keywords of the opt-in category filter.
FOOD_KEYWORDS = (
    "alimento",
    "bebida",
    "lacteo",
    "carne",
    "fruta",
    "verdura",
    "panaderia",
    "fiambreria",
    "congelado",
    "almacen",
)

# Preset baskets as search terms.
PRESET_BASKETS = {
    "Canasta básica (10 productos)": (
        "LECHE",
        "PAN ",
        "ACEITE",
        "ARROZ",
        "FIDEOS",
        "AZUCAR",
        "YERBA",
        "HARINA",
        "HUEVO",
        "CAFE",
    ),
    "Desayuno": ("LECHE", "CAFE", "AZUCAR", "GALLETITAS", "MERMELADA"),
    "Limpieza": ("LAVANDINA", "DETERGENTE", "JABON", "PAPEL HIGIENICO"),
    "Bebidas": ("GASEOSA", "AGUA", "CERVEZA", "VINO", "JUGO"),
}


@dataclass(frozen=True)
class Settings:
    """Thresholds of the jobs; every operator takes what it needs as an argument."""

    min_price: float = 0.01
    max_price: float = 50_000_000.0
    category_filter: bool = False
    food_keywords: tuple[str, ...] = FOOD_KEYWORDS
    min_store_samples: int = 50
    trim: float = 0.05
    min_trim_samples: int = 20
    retention_days: int = 7
    raw_keep_days: int = 7
