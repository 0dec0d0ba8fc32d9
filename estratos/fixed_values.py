"""Words, codes, defaults and limits that results depend on.

These are data, not logic. Header aliases are listed per target column, in order of preference: when two
headers of one file map to the same target, the first non-null value in this order wins.
"""

from __future__ import annotations

# --- Header aliases of the raw files ---------------------------------------------------------------

ARRIVALS_HEADERS = {
    "arrival_date": ["arrival_date", "fecha_llegada"],
    "year": ["year", "año", "anio", "vigencia"],
    "month": ["month", "mes", "periodo"],
    "country_of_origin": [
        "country_of_origin", "pais", "país", "pais_origen", "country", "pais de residencia", "país de residencia",
    ],
    "destination_department": ["destination_department", "departamento", "departamento_destino", "destino"],
    "number_of_visitors": [
        "number_of_visitors", "visitantes", "llegadas", "total", "arrivals", "viajeros", "turistas",
        "numero_viajeros", "numero_visitantes",
    ],
    "estimated_spending_usd": [
        "estimated_spending_usd", "gasto", "gasto_usd", "spending", "gasto_estimado_usd",
    ],
    "travel_purpose": ["travel_purpose", "motivo", "motivo_viaje", "tipo_viaje"],
    "entry_point": ["entry_point", "punto_entrada", "entrada", "tipo_ingreso", "via"],
}

OCCUPANCY_HEADERS = {
    "year": ["year", "año", "anio", "vigencia"],
    "month": ["month", "mes"],
    "department": ["department", "departamento", "region"],
    "occupancy_rate": [
        "occupancy_rate", "ocupacion", "porcentaje_ocupacion", "tasa_ocupacion", "ocupacion_hotelera",
    ],
    "available_rooms": ["available_rooms", "habitaciones_disponibles", "cuartos_disponibles"],
    "occupied_rooms": ["occupied_rooms", "habitaciones_ocupadas", "habitaciones_vendidas"],
    "average_rate_cop": ["average_rate_cop", "tarifa_promedio", "tarifa_promedio_cop", "adr"],
}

AIR_HEADERS = {
    "year": ["year", "año", "anio"],
    "month": ["month", "mes"],
    "airport": ["airport", "aeropuerto"],
    "airport_city": ["airport_city", "ciudad", "city"],
    "domestic_passengers": ["domestic_passengers", "pasajeros_nacionales"],
    "international_passengers": ["international_passengers", "pasajeros_internacionales"],
    "total_passengers": ["total_passengers", "total_pasajeros"],
    "flight_type": ["flight_type", "tipo_vuelo"],
}

BALANCE_HEADERS = {
    "year": ["year", "año", "anio"],
    "quarter": ["quarter", "trimestre"],
    "tourism_income_usd_millions": ["tourism_income_usd_millions", "ingresos_turismo_usd", "ingresos"],
    "tourism_expenditure_usd_millions": ["tourism_expenditure_usd_millions", "egresos_turismo_usd", "egresos"],
    "tourism_balance_usd_millions": ["tourism_balance_usd_millions", "balance"],
    "source": ["source"],
}

GDP_HEADERS = {
    "year": ["year", "año", "anio"],
    "tourism_gdp_billions_cop": ["tourism_gdp_billions_cop"],
    "pct_of_total_gdp": ["pct_of_total_gdp"],
    "tourism_employment_thousands": ["tourism_employment_thousands"],
    "annual_variation_pct": ["annual_variation_pct"],
    "source": ["source"],
}

MIGRATION_HEADERS = {
    "year": ["year", "año", "anio"],
    "month": ["month", "mes"],
    "nationality": ["nationality"],
    "movement_type": ["movement_type"],
    "control_point": ["control_point"],
    "number_of_travelers": ["number_of_travelers"],
    "source": ["source"],
}

# --- Defaults and limits ---------------------------------------------------------------------------

UNKNOWN = "Desconocido"
DEFAULT_PURPOSE = "Turismo"
DEFAULT_ENTRY_POINT = "Aéreo"
DEFAULT_OCCUPANCY_RATE = 50.0
DEFAULT_QUARTER = 1
MID_MONTH_DAY = 15

BRONZE_MIN_YEAR = 2010
BRONZE_BALANCE_MIN_YEAR = 2006
SILVER_ARRIVALS_MIN_YEAR = 2015
SILVER_OCCUPANCY_MIN_YEAR = 2015
SILVER_MIGRATION_MIN_YEAR = 2015
SILVER_GDP_MIN_YEAR = 2010
SILVER_AIR_MIN_YEAR = 2010
SILVER_BALANCE_MIN_YEAR = 2006
SILVER_INDICATOR_MIN_YEAR = 2010

SOURCE_GDP = "dane"
SOURCE_MIGRATION = "migracion_colombia"
SOURCE_BALANCE = "banrep"
SOURCE_INDICATORS = "world_bank"

MOVEMENT_IN = "entrada"
MOVEMENT_OUT = "salida"
NO_FILTER = "Todos"
SURPLUS = "Superávit"
DEFICIT = "Déficit"

# Text that stands for a missing value in a surrogate key.
KEY_NULL = "_dbt_utils_surrogate_key_null_"

# Cell texts read as missing, the default list of pandas' CSV reader.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Unicode space separators (category Zs), which `trim` removes in silver text.
SPACES = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)

CALENDAR_START = "2019-01-01"
CALENDAR_END = "2026-12-31"

# --- Indicator catalogue ---------------------------------------------------------------------------

ARRIVALS_CODE = "ST.INT.ARVL"
RECEIPTS_CODE = "ST.INT.RCPT.CD"
EXPORT_SHARE_CODE = "ST.INT.RCPT.XP.ZS"

INDICATORS = {
    "ST.INT.ARVL": "international_arrivals",
    "ST.INT.DPRT": "resident_departures",
    "ST.INT.RCPT.CD": "tourism_receipts_current_usd",
    "ST.INT.XPND.CD": "tourism_expenditure_usd",
    "ST.INT.RCPT.XP.ZS": "tourism_pct_of_exports",
    "NY.GDP.MKTP.CD": "gdp_current_usd",
}

REGIONAL_INDICATORS = ["ST.INT.ARVL", "ST.INT.RCPT.CD"]

REGIONAL_COUNTRIES = {
    "COL": "Colombia",
    "ECU": "Ecuador",
    "PER": "Perú",
    "PAN": "Panamá",
    "BRA": "Brasil",
    "MEX": "México",
    "CRI": "Costa Rica",
}

# --- Calendar words --------------------------------------------------------------------------------

DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"]

MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]

MONTH_SHORT_NAMES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]

# --- Department coordinates (latitude, longitude) --------------------------------------------------

DEFAULT_COORDINATES = (4.5, -74.0)

DEPARTMENT_COORDINATES = {
    "Bogotá D.C.": (4.711, -74.072),
    "Antioquia": (6.252, -75.564),
    "Valle Del Cauca": (3.452, -76.532),
    "Bolívar": (10.400, -75.514),
    "Atlántico": (10.964, -74.781),
    "Santander": (7.130, -73.126),
    "San Andrés": (12.584, -81.701),
    "Magdalena": (11.241, -74.199),
    "Nariño": (1.287, -77.391),
    "Risaralda": (4.814, -75.696),
    "Quindío": (4.534, -75.681),
    "Boyacá": (5.534, -73.362),
    "Cundinamarca": (4.983, -74.067),
    "Norte De Santander": (7.894, -72.508),
    "Caldas": (5.066, -75.517),
    "Tolima": (4.438, -75.232),
    "Huila": (2.927, -75.282),
    "Cesar": (10.473, -73.253),
    "Meta": (4.153, -73.636),
    "Cauca": (2.442, -76.606),
    "Sucre": (9.304, -75.398),
    "Córdoba": (8.748, -75.881),
    "La Guajira": (11.544, -72.907),
    "Casanare": (5.337, -72.395),
    "Amazonas": (-1.012, -71.984),
    "Putumayo": (1.152, -76.652),
    "Chocó": (5.691, -76.658),
    "Arauca": (7.090, -70.762),
    "Caquetá": (1.614, -75.612),
    "Guaviare": (2.570, -72.641),
    "Vaupés": (1.198, -70.174),
    "Vichada": (4.423, -69.750),
    "Guainía": (3.865, -67.924),
}

# Date texts that are read besides ISO dates and timestamps, in order of preference.
DATE_FORMATS = [
    "yyyyMMdd", "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy",
    "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "d-MMM-yyyy",
    "yyyy/M/d H:mm:ss", "M/d/yyyy H:mm:ss", "d/M/yyyy H:mm:ss", "M/d/yyyy H:mm", "d/M/yyyy H:mm",
]
