"""Reference seeds and fixed values.

FIXED VALUES: everything in this module must equal the values of the system being
re-implemented, because results depend on them (lookup rows, keyword order, codes,
bounds, constants). They are stated plainly, in their natural order. Nothing here
is computed; the Spark code builds broadcastable DataFrames from these literals.
"""
from __future__ import annotations

# --- FIXED VALUES: reference lookup rows -------------------------------------

# operators(code, name, city, website)
OPERATORS = [
    ("TLT", "Tallinna Linnatransport", "Tallinn", "https://tlt.ee"),
    ("Elron", "Elron", "Regional", "https://elron.ee"),
    ("SEBE", "SEBE", "Regional", "https://sebe.ee"),
]

# line_types(code, name, name_et, fuel_category)
LINE_TYPES = [
    (1, "tram", "tramm", "electric"),
    (2, "bus", "buss", "mixed"),
    (3, "trolleybus", "troll", "electric"),
]

# fuel_types(code, name, unit)
FUEL_TYPES = [
    ("diesel", "Diislikütus", "litre"),
    ("95", "Bensiin 95", "litre"),
    ("98", "Bensiin 98", "litre"),
    ("electric", "Elekter", "kwh"),
    ("gas", "CNG gaas", "kg"),
    ("hybrid_diesel", "Hübriid-diisel", "litre"),
]

# cities(code, name, lat_min, lat_max, lon_min, lon_max)
CITIES = [
    ("tallinn", "Tallinn", 59.35, 59.55, 24.55, 24.95),
    ("tartu", "Tartu", 58.30, 58.45, 26.60, 26.85),
    ("regional", "Regionaalne", 57.50, 59.70, 21.50, 28.20),
]

# elron_line_types(liin, fuel_type, model, notes)
ELRON_LINE_TYPES = [
    ("Tallinn - Keila", "electric", "Stadler FLIRT EMU", "Elektriraudtee 3kV võrk"),
    ("Keila - Tallinn", "electric", "Stadler FLIRT EMU", "Elektriraudtee 3kV võrk"),
    ("Tallinn - Pääsküla", "electric", "Stadler FLIRT EMU", "Elektriraudtee 3kV võrk"),
    ("Pääsküla - Tallinn", "electric", "Stadler FLIRT EMU", "Elektriraudtee 3kV võrk"),
    ("Tallinn - Kloogaranna", "electric", "Škoda 21Ev EMU", "Škoda 21Ev, alates 2025"),
    ("Kloogaranna - Tallinn", "electric", "Škoda 21Ev EMU", "Škoda 21Ev, alates 2025"),
    ("Tallinn - Tapa", "electric", "Škoda 21Ev EMU", "Škoda 21Ev, alates jan 2026"),
    ("Tapa - Tallinn", "electric", "Škoda 21Ev EMU", "Škoda 21Ev, alates jan 2026"),
    ("Tallinn - Tartu", "diesel", "Stadler FLIRT DMU", "Elektrifitseerimine käimas"),
    ("Tartu - Tallinn", "diesel", "Stadler FLIRT DMU", "Elektrifitseerimine käimas"),
    ("Tallinn - Narva", "diesel", "Stadler FLIRT DMU", "Elektrifitseerimine käimas"),
    ("Narva - Tallinn", "diesel", "Stadler FLIRT DMU", "Elektrifitseerimine käimas"),
    ("Tallinn - Viljandi", "diesel", "Stadler FLIRT DMU", None),
    ("Viljandi - Tallinn", "diesel", "Stadler FLIRT DMU", None),
    ("Tallinn - Rapla", "diesel", "Stadler FLIRT DMU", None),
    ("Rapla - Tallinn", "diesel", "Stadler FLIRT DMU", None),
    ("Tallinn - Paldiski", "diesel", "Stadler FLIRT DMU", None),
    ("Paldiski - Tallinn", "diesel", "Stadler FLIRT DMU", None),
    ("Tallinn - Turba", "diesel", "Stadler FLIRT DMU", None),
    ("Turba - Tallinn", "diesel", "Stadler FLIRT DMU", None),
    ("Tallinn - Aegviidu", "diesel", "Stadler FLIRT DMU", None),
    ("Aegviidu - Tallinn", "diesel", "Stadler FLIRT DMU", None),
    ("Tallinn - Rakvere", "diesel", "Stadler FLIRT DMU", None),
    ("Rakvere - Tallinn", "diesel", "Stadler FLIRT DMU", None),
    ("Tallinn - Riia", "diesel", "Stadler FLIRT DMU", "Rahvusvaheline liin"),
    ("Riia - Tallinn", "diesel", "Stadler FLIRT DMU", "Rahvusvaheline liin"),
    ("Tartu - Valga", "diesel", "Stadler FLIRT DMU", None),
    ("Valga - Tartu", "diesel", "Stadler FLIRT DMU", None),
    ("Tartu - Koidula", "diesel", "Stadler FLIRT DMU", None),
    ("Tartu - Piusa", "diesel", "Stadler FLIRT DMU", None),
    ("Jõgeva - Tartu", "diesel", "Stadler FLIRT DMU", None),
]

# --- FIXED VALUES: model classification (first contained keyword wins) --------

# keyword -> fuel type code; order matters; default "diesel"
FUEL_KEYWORDS = [
    ("32tr", "electric"),
    ("33tr", "electric"),
    ("electric", "electric"),
    ("cng", "gas"),
    ("hybrid", "hybrid_diesel"),
    ("trollino", "electric"),
    ("škoda 14", "electric"),
    ("tatra", "electric"),
    ("pesa", "electric"),
    ("caf", "electric"),
    ("flirt emu", "electric"),
    ("flirt", "diesel"),
]
DEFAULT_FUEL = "diesel"

# keyword -> consumption per 100 km; order matters; default NULL
CONSUMPTION_KEYWORDS = [
    ("pesa twist 147n", 8.5),
    ("caf urbos axl", 8.0),
    ("tatra kt4tmr", 9.0),
    ("tatra kt4", 9.0),
    ("tatra kt6tm", 8.8),
    ("škoda 32tr", 2.5),
    ("škoda 33tr", 3.0),
    ("solaris trollino iii 18 ac", 3.0),
    ("solaris trollino iii 12 ac", 2.5),
    ("škoda 14tr", 2.8),
    ("solaris urbino iv 12 electric", 120.0),
    ("solaris urbino iv 12 cng", 32.0),
    ("solaris urbino iv 18 cng", 42.0),
    ("man a78", 32.0),
    ("man a40", 42.0),
    ("man a21", 30.0),
    ("volvo 7900 hybrid", 24.0),
    ("mercedes-benz sprinter", 15.0),
    ("stadler flirt emu", 8.0),
    ("stadler flirt", 3.5),
    ("škoda 21ev", 8.0),
]

# fuel type code -> consumption unit; default "l/100km"
CONSUMPTION_UNITS = [
    ("electric", "kWh/100km"),
    ("gas", "kg/100km"),
    ("diesel", "l/100km"),
    ("hybrid_diesel", "l/100km"),
]
DEFAULT_CONSUMPTION_UNIT = "l/100km"

# (operator, line_type_code, model) -> vehicle amount, fallback when a fleet page has no count
KNOWN_AMOUNTS = [
    ("TLT", 1, "PESA Twist 147N", 23),
    ("TLT", 1, "CAF Urbos AXL", 10),
    ("TLT", 1, "Tatra KT4", 8),
    ("TLT", 1, "Tatra KT6TM", 10),
    ("TLT", 1, "Tatra KT4TMR", 8),
    ("TLT", 3, "Solaris Trollino III 18 AC", 1),
    ("TLT", 3, "Solaris Trollino III 12 AC", 1),
    ("TLT", 3, "Škoda 14Tr", 1),
    ("TLT", 2, "Solaris Urbino IV 12 Electric", 15),
    ("TLT", 2, "Solaris Urbino IV 12 CNG", 200),
    ("TLT", 2, "Solaris Urbino IV 18 CNG", 150),
    ("TLT", 2, "MAN A78 Lion's City LE EL293", 50),
    ("TLT", 2, "MAN A40 Lion's City GL NG323", 30),
    ("TLT", 2, "MAN A21 Lion's City NL283", 5),
    ("TLT", 2, "Volvo 7900 Hybrid", 10),
    ("TLT", 2, "Mercedes-Benz Sprinter", 5),
]

# train models entered by hand:
# (operator_code, line_type_code, model, fuel_type_code, consumption, consumption_unit, vehicle_amount)
ELRON_MODELS = [
    ("Elron", 2, "Stadler FLIRT DMU", "diesel", 3.5, "l/100km", 20),
    ("Elron", 2, "Stadler FLIRT EMU", "electric", 8.0, "kWh/100km", 18),
    ("Elron", 2, "Škoda 21Ev (pikamaa)", "electric", 8.0, "kWh/100km", 11),
    ("Elron", 2, "Škoda 21Ev (linnalähirong)", "electric", 6.0, "kWh/100km", 5),
]

# the one model kept but marked inactive
INACTIVE_MODEL = "Mercedes-Benz Sprinter"

# fleet pages in scrape order: (page name, line_type_code)
FLEET_PAGES = [
    ("trammid", 1),
    ("trollid", 3),
    ("bussid", 2),
]

# headings on fleet pages that are not models (compared lower-cased)
SKIP_HEADINGS = [
    "kontakt",
    "sõidukite tellimine",
    "bussiveerem",
    "trammiveerem",
    "trolliveerem",
    "kasutame küpsiseid",
]
MIN_HEADING_LENGTH = 5

# price-table name -> fuel type; first contained key wins
FUEL_NAME_MAP = [
    ("bensiin 95", "95"),
    ("bensiin 98", "98"),
    ("diislikütus", "Diesel"),
    ("diisel", "Diesel"),
]

# --- FIXED VALUES: constants used by parsers and models -----------------------

GPS_OPERATOR = "TLT"
TRAIN_OPERATOR = "Elron"

# inclusive bounding box for accepted coordinates
LAT_MIN, LAT_MAX = 57.50, 60.00
LON_MIN, LON_MAX = 21.50, 28.50

# GPS feed: minimum number of comma separated fields
GPS_MIN_FIELDS = 10
# fixed-point coordinate scale of the raw GPS feed
GPS_COORD_SCALE = 1_000_000

# plausibility ranges for prices (inclusive)
FUEL_PRICE_MIN, FUEL_PRICE_MAX = 0.5, 3.0
CNG_PRICE_MIN, CNG_PRICE_MAX = 1.0, 5.0
# CNG sentence pattern, first match only
CNG_PRICE_PATTERN = r"(\d+[.,]\d+)\s*(?:euroni|€)\s*(?:kilogrammist|/\s*kg)"
# vehicle count in fleet page text
VEHICLE_AMOUNT_PATTERN = r"(\d+)\s+tükk"

# estimated km per vehicle per day by transport type; default 200
KM_PER_DAY = [
    ("tram", 180),
    ("trolleybus", 160),
    ("bus", 225),
    ("train", 800),
]
DEFAULT_KM_PER_DAY = 200

# accepted values of the source data tests
ACCEPTED_OPERATORS = ["TLT", "Elron"]
ACCEPTED_FUEL_TYPES = ["95", "98", "Diesel", "electric", "CNG"]

# feed night pause: start <= hour < end
NIGHT_START_HOUR, NIGHT_END_HOUR = 0, 6
