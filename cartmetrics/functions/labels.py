"""Label vocabularies and ordered pattern rules, evaluated as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import lookup, norm_key, null_column

# --- fixed values: channel vocabulary ----------------------------------------------------------

CHANNELS = ("MODERNO", "TRADICIONAL", "INTERNOS")
CHANNEL_GROUPS = ("UTT", "DTT", "INTERNAL")

RAW_TO_CHANNEL = {
    "UTT": "MODERNO",
    "DTT": "TRADICIONAL",
    "INTERNAL": "INTERNOS",
    "MODERNO": "MODERNO",
    "NC MODERNO": "MODERNO",
    "TRADICIONAL": "TRADICIONAL",
    "INTERNOS": "INTERNOS",
}

CHANNEL_TO_GROUP = {"MODERNO": "UTT", "TRADICIONAL": "DTT", "INTERNOS": "INTERNAL"}

CHANNEL_TO_ROUTE = {
    "MODERNO": "COMMERCIAL",
    "TRADICIONAL": "COMMERCIAL",
    "INTERNOS": "INTERNAL_OPERATION",
}

MARKET_TO_CHANNEL = {
    "AUTOSERVICIO": "MODERNO",
    "AUTOSERVICIO_SCANNING": "MODERNO",
    "AUTOSERVICIO_SURTIDO_COMPLETO": "MODERNO",
    "MODERNO_TOTAL": "MODERNO",
    "CONVENIENCIA": "MODERNO",
    "FARMACIAS": "MODERNO",
    "MINISUPER": "MODERNO",
    "MAYOREO": "TRADICIONAL",
    "TRADICIONAL": "TRADICIONAL",
    "MODERNO": "MODERNO",
}

# --- fixed values: market label patterns, first match wins --------------------------------------

UNCLASSIFIED = "SIN_CLASIFICAR"

TOTAL_LEVEL = (
    r"(^| )TOTAL( |$)|(^| )T PAIS( |$)|MX TOTAL|AREA [0-9IVX]+ *[+\-]|AREAS [0-9IVX]+"
)

BROAD_CHANNEL = (
    (r"TRADICIONAL|TRADICIONALES|TRADICONAL", "TRADICIONAL"),
    (
        r"MODERNO|AUTOS|AUTOSERVICIOS|AUTOSERVICIO|GRANDES CADENAS|PROXIMIDAD|TDC|FARMACIAS"
        r"|HARD DISCOUNTERS|SCANNING|MAYORISTAS",
        "MODERNO",
    ),
)

FINE_CHANNEL = (
    (r"TRADICIONALES GRANDES|MEXICO GRANDES|MEXICO GDE|GRANDES Y MINISUPERS", "TRADICIONAL_GRANDES_MINISUPERS"),
    (r"TRADICIONALES PEQUENAS|MEXICO PEQUENAS|PEQUENAS Y ESTANQUILLOS", "TRADICIONAL_PEQUENAS_ESTANQUILLOS"),
    (r"TRADICIONAL|TRADICIONALES|TRADICONAL", "TRADICIONAL"),
    (r"TDC|FARMACIAS|HARD DISCOUNTERS", "TDC_FARMACIAS_HARD_DISCOUNTERS"),
    (r"PROXIMIDAD", "PROXIMIDAD"),
    (r"MAYORISTAS", "AUTOSERVICIOS_MAYORISTAS"),
    (r"GRANDES CADENAS", "GRANDES_CADENAS_AUTOSERVICIO"),
    (r"SURTIDO EXTENDIDO|SURT EXTENDIDO", "AUTOSERVICIO_SURTIDO_EXTENDIDO"),
    (r"SURTIDO COMPLETO|SURT COMPLETO", "AUTOSERVICIO_SURTIDO_COMPLETO"),
    (r"SURTIDO ESENCIAL|SURT ESENCIAL", "AUTOSERVICIO_SURTIDO_ESENCIAL"),
    (r"SCANNING|SCANTRACK", "AUTOSERVICIO_SCANNING"),
    (r"AUTOS|AUTOSERVICIOS|AUTOSERVICIO", "AUTOSERVICIO"),
    (r"MODERNO", "MODERNO_TOTAL"),
)

REGION_TYPE = (
    (r"TOTAL MEXICO|MX TOTAL|T PAIS|TOTAL \+MEXICO", "NATIONAL"),
    (r"AREA [0-9]+\.[0-9]+|AREA [0-9]+|AREA [IVX]+|AREAS [0-9IVX]+", "AREA"),
    (r"VDM|VALLE DE MEXICO", "VDM"),
)

# Area numbers end at a word boundary, so AREA 1 does not match AREA 10.
AREA = (
    (r"AREA 1 *\+ *AREA 2( |$)|AREAS 1 *\+ *2( |$)", "AREA_1_2"),
    (r"AREA 3 *[+\-] *AREA 6( |$)|AREAS 3 *\+ *4 *\+ *5 *\+ *6( |$)", "AREA_3_6"),
    (r"AREA 1([^0-9]|$)|AREA I( |$)", "AREA_1"),
    (r"AREA 2([^0-9]|$)|AREA II( |$)", "AREA_2"),
    (r"AREA 3([^0-9]|$)|AREA III( |$)", "AREA_3"),
    (r"AREA 4([^0-9]|$)|AREA IV( |$)", "AREA_4"),
    (r"AREA 5([^0-9]|$)|AREA V( |$)", "AREA_5"),
    (r"AREA 6([^0-9]|$)|AREA VI( |$)", "AREA_6"),
)

# Zone numbers end at a word boundary, so zone I does not swallow zones II to IV.
REGION_DETAIL = (
    (r"AREA 2\.1([^0-9]|$)", "AREA_2_1_CONTINENTAL"),
    (r"AREA 2\.2([^0-9]|$)", "AREA_2_2_GOLFO"),
    (r"AREA 6\.1([^0-9]|$)", "AREA_6_1_PENINSULA"),
    (r"AREA 6\.2([^0-9]|$)", "AREA_6_2_SUR"),
    (r"VDM ZONA (I|1)( |$)", "VDM_ZONA_1"),
    (r"VDM ZONA (II|2)( |$)", "VDM_ZONA_2"),
    (r"VDM ZONA (III|3)( |$)", "VDM_ZONA_3"),
    (r"VDM ZONA (IV|4)( |$)", "VDM_ZONA_4"),
)

CITY_PREFIX = (
    r"^(TOTAL AUTOS SCANNING|TOTAL AUTOS|AUTOSERVICIOS SCANNING|GRANDES CADENAS DE AUTOSERVICIO"
    r"|TDC \+ FARMACIAS CAD \+ HARD DISCOUNTERS|AUTOSERVICIOS MAYORISTAS|AUTOSERVICIOS"
    r"|CANAL TRADICIONAL|CANAL MODERNO|TRADICIONALES GRANDES|TRADICIONALES PEQUENAS"
    r"|TRADICIONALES|TRADICIONAL|TRADICONAL|AUTOS SCANNING|AUTOS"
    r"|MODERNO|C MODERNO|C PROXIMIDAD|PROXIMIDAD|TOTAL) +"
)


# --- expressions -------------------------------------------------------------------------------


def first_match(col: Column, rules: Sequence[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """Label of the first pattern found in the text."""
    expr = None
    for pattern, label in rules:
        hit = col.rlike(pattern)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr if otherwise is None else expr.otherwise(otherwise)


def channel_std(raw: Column) -> Column:
    return lookup(norm_key(raw), RAW_TO_CHANNEL)


def channel_group(channel: Column) -> Column:
    return lookup(norm_key(channel), CHANNEL_TO_GROUP)


def business_route(channel: Column) -> Column:
    return lookup(norm_key(channel), CHANNEL_TO_ROUTE)


def market_channel_std(market_channel: Column) -> Column:
    return lookup(norm_key(market_channel), MARKET_TO_CHANNEL)


def clean_market_label(raw: Column) -> Column:
    """Drop the '_MT' suffix, turn '_' into blanks, drop dots that touch no digit, squeeze blanks."""
    text = F.regexp_replace(raw, r"_MT\s*$", "")
    text = F.translate(text, "_", " ")
    text = F.regexp_replace(text, r"(?<!\d)\.(?!\d)", "")
    return F.upper(F.trim(F.regexp_replace(text, r"\s+", " ")))


def market_label_classify(raw: Column) -> dict[str, Column]:
    """Aggregation level, channel levels and region labels of a free-text market label."""
    text = clean_market_label(raw)
    level = F.when(text.rlike(TOTAL_LEVEL), "TOTAL").otherwise("DETAIL")
    no_channel = F.when(level == "TOTAL", "TOTAL_MERCADO").otherwise(UNCLASSIFIED)
    region_type = first_match(text, REGION_TYPE, F.lit("CITY"))
    fine = first_match(text, FINE_CHANNEL, no_channel)
    region = F.when(region_type == "NATIONAL", "TOTAL_MEXICO").otherwise(
        first_match(
            text,
            AREA,
            F.when(region_type == "VDM", "VDM").otherwise(F.trim(F.regexp_replace(text, CITY_PREFIX, ""))),
        )
    )
    return {
        "market_label": text,
        "agg_level": level,
        "canal_lvl1": first_match(text, BROAD_CHANNEL, no_channel),
        "canal_lvl2": fine,
        "region_type": region_type,
        "region_std": region,
        "region_detail": first_match(text, REGION_DETAIL, null_column()),
        "review_status": F.when(fine == UNCLASSIFIED, "NEEDS_REVIEW").otherwise("CONFIRMED"),
    }


def is_scanning(channel: Column) -> Column:
    return F.when(channel.like("%SCANNING%"), "YES").otherwise("NO")


def is_total_mexico(region: Column) -> Column:
    return F.when(norm_key(region) == "TOTAL_MEXICO", "YES").otherwise("NO")
