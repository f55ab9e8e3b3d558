"""Labels, codes and column maps the warehouse must reproduce exactly.

Everything in the block below is a fixed value: the published star schema
stores these literal strings, so they are stated here verbatim and in their
natural order.  Code elsewhere derives arrays, CASE chains and rename maps
from them instead of repeating the literals.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Fixed values (must equal the published warehouse byte for byte)
# --------------------------------------------------------------------------

# Label stored for any missing or blank text attribute.
UNKNOWN_TEXT = "Sin especificar"

# Time dimension member for an unknown hour/minute.
UNKNOWN_TIME_KEY = -1
UNKNOWN_TIME_TEXT = "Sin esp."
UNKNOWN_TIME_BAND = "Sin especificar"

# Month names, January first.
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]

# ISO weekday names, Monday = 1 first.
DAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

# ISO weekday numbers that form the weekend.
WEEKEND_DAYS = [6, 7]

# Time bands as (label, first hour, last hour), in presentation order.
TIME_BANDS = [
    ("Madrugada", 0, 5),
    ("Mañana", 6, 11),
    ("Tarde", 12, 17),
    ("Noche", 18, 23),
]

# Vehicle counts: raw column -> fact column (13, in table order).
VEHICLE_COLUMNS = {
    "automovil": "automovil",
    "campasaj": "campasaj",
    "microbus": "microbus",
    "pascamion": "pascamion",
    "omnibus": "omnibus",
    "tranvia": "tranvia",
    "camioneta": "camioneta",
    "camion": "camion",
    "tractor": "tractor",
    "ferrocarri": "ferrocarril",
    "motociclet": "motocicleta",
    "bicicleta": "bicicleta",
    "otrovehic": "otro_vehiculo",
}

# Casualty counts: raw column -> fact column (12, in table order).
PERSON_COLUMNS = {
    "condmuerto": "conductor_muerto",
    "condherido": "conductor_herido",
    "pasamuerto": "pasajero_muerto",
    "pasaherido": "pasajero_herido",
    "peatmuerto": "peaton_muerto",
    "peatherido": "peaton_herido",
    "ciclmuerto": "ciclista_muerto",
    "ciclherido": "ciclista_herido",
    "otromuerto": "otro_muerto",
    "otroherido": "otro_herido",
    "nemuerto": "total_muertos",
    "neherido": "total_heridos",
}

# Vehicle ranking report: (label, fact column), ten of the thirteen columns.
RANKED_VEHICLES = [
    ("Automovil", "automovil"),
    ("Motocicleta", "motocicleta"),
    ("Bicicleta", "bicicleta"),
    ("Camioneta", "camioneta"),
    ("Camion", "camion"),
    ("Microbus", "microbus"),
    ("Omnibus", "omnibus"),
    ("Tractor", "tractor"),
    ("Ferrocarril", "ferrocarril"),
    ("Otro vehiculo", "otro_vehiculo"),
]

# Raw columns coerced to integers besides the measures.
CALENDAR_NUMERIC_COLUMNS = ["anio", "mes", "id_dia", "id_hora", "id_minuto", "id_edad"]

# Source renames of the incident descriptors and driver attributes.
DESCRIPTOR_COLUMNS = {
    "tipaccid": "tipo_accidente",
    "causaacci": "causa_accidente",
    "clasacc": "clasificacion",
    "urbana": "zona_urbana",
    "suburbana": "zona_suburbana",
    "caparod": "capa_rodamiento",
    "estatus": "estatus",
}
DRIVER_COLUMNS = {
    "sexo": "sexo",
    "id_edad": "id_edad",
    "edad_descripcion": "edad_descripcion",
    "aliento": "aliento_alcoholico",
    "cinturon": "cinturon_seguridad",
}
LOCATION_COLUMNS = ["id_entidad", "entidad", "id_municipio", "municipio", "cobertura"]
# Text columns that are cleaned: every attribute that is not an id.
TEXT_COLUMNS = [c for c in (*LOCATION_COLUMNS, *DESCRIPTOR_COLUMNS, *DRIVER_COLUMNS)
                if not c.startswith("id_")]

# Input files of one yearly load.
INCIDENT_FILE = "atus_anual_2024.csv"
CATALOG_FILES = {
    "entidad": "tc_entidad.csv",
    "municipio": "tc_municipio.csv",
    "edad": "tc_edad.csv",
}

# Tokens a default pandas CSV reader turns into a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Maximum text length of every label column of the star (VARCHAR(n)).
TEXT_LIMITS = {
    "dim_fecha": {"mes_nombre": 15, "dia_semana_nombre": 15},
    "dim_tiempo": {"hora_texto": 8, "banda_horaria": 20},
    "dim_ubicacion": {"entidad": 80, "municipio": 150, "cobertura": 50},
    "dim_accidente": {"tipo_accidente": 150, "causa_accidente": 100, "clasificacion": 60,
                      "zona_urbana": 100, "zona_suburbana": 100, "capa_rodamiento": 100,
                      "estatus": 100},
    "dim_conductor": {"sexo": 40, "edad_descripcion": 100, "aliento_alcoholico": 40,
                      "cinturon_seguridad": 40},
}

# Range of a SMALLINT column.
SMALLINT_MIN, SMALLINT_MAX = -32768, 32767

# --------------------------------------------------------------------------
# Derived from the fixed values above
# --------------------------------------------------------------------------

BAND_ORDER = [label for label, _, _ in TIME_BANDS] + [UNKNOWN_TIME_BAND]
