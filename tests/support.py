"""Helpers of the tests: collected rows and generated archives."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

DATE = "2026-07-21"


def rows(df, *columns):
    """Result as a list of tuples of the given columns."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# --- archives --------------------------------------------------------------------------------

_RETAIL = (
    "﻿id_comercio|id_bandera|id_sucursal|id_producto|productos_ean|productos_descripcion|"
    "productos_marca|productos_precio_lista|productos_precio_referencia|otra\n"
)
PRODUCTS = (
    _RETAIL + "4|1|289|101|1|BEBIDA A| |3700.00|3700.00|x\n"
    '4 |1|289|102|1|"CREMA | 60 G"|MARCA UNO|12250.00|12250.00|x\n'
    "4|1|289|103|1|LECHE 1L|MARCA DOS|960.25|NA\n"
    "4|1|289|104|1|SIN PRECIO| |N/D|N/D|x\n"
    "4|1|289|105|1|NEGATIVO| |-99.00|1|x\n"
    "4|1|289|106|1|CAMPOS DE MAS|A|5|5|x|y|z\n"
    " \n\nUltima actualizacion: 2026-03-04T05:06:07-03:00\n"
)
STORES = (
    "﻿id_comercio|id_bandera|id_sucursal|sucursales_nombre|sucursales_provincia\n"
    "4|1|289|CENTRO|ar-c\n4|1|289|COPIA|AR-B\n\nUltima actualizacion: x\n"
)
CHAINS = (
    "id_comercio|id_bandera|comercio_razon_social|comercio_bandera_nombre\n"
    "4|1|RAZON SUR|TIENDA SUR\n"
)
WHOLESALE_PRODUCTS = (
    "id_comercio|id_bandera|id_sucursal|id_producto|productos_descripcion|"
    "precio_unitario_bulto_por_unidad_venta_con_iva|unidad_venta\n"
    "62|1|1|201|TIZAS|733.25|BULTO\n62|1|1|202|CARTÓN|1988.5|BULTO\n"
    "última actualización: 2026-07-21\n"
)
WHOLESALE_STORES = (
    "id_comercio|id_bandera|id_sucursal|sucursales_nombre|sucursales_provincia\n"
    "62|1|1|DEPOSITO|AR-J\n"
)


def inner_zip(encoding="utf-8", **members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(f"carpeta/{name.capitalize()}.csv", text.encode(encoding))
    return buffer.getvalue()


def write_archive(root, tipo, fecha, folder=None, **retailers):
    """One raw file ``<root>/<tipo>/fecha=<fecha>/x.zip`` holding the given inner archives."""
    path = Path(root) / tipo / f"fecha={fecha}" / f"sepa_{tipo}_{fecha}.zip"
    path.parent.mkdir(parents=True, exist_ok=True)
    folder = folder or fecha
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as outer:
        outer.writestr(f"{folder}/", "")
        for name, payload in retailers.items():
            outer.writestr(f"{folder}/{name}.zip", payload)
    return path


def retail_archive(root, fecha=DATE):
    return write_archive(
        root,
        "minorista",
        fecha,
        a_retail=inner_zip(productos=PRODUCTS, sucursales=STORES, comercio=CHAINS),
        b_empty=b"",
        c_corrupt=b"this is no zip",
        d_no_products=inner_zip(sucursales=STORES),
    )
