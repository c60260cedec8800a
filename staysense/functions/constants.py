"""Fixed values.

Everything below must equal the published behaviour for results to match, so it
is stated plainly, in the original order.  Nothing else in the library
hard-codes business numbers; they are passed in from here as parameters.
"""

# --- fixed values: booking defaults used by the gift decision -----------------
DEFAULT_NIGHTS = 2
DEFAULT_GUESTS = 2
DEFAULT_RATE = 250.0
DEFAULT_BOARD = "SC"
UNKNOWN_TEXT = "Unknown"
CAMPAIGN_COST_PER_OFFER = 5.0
DEFAULT_FALLBACK_THRESHOLD = 0.4912
DEFAULT_AVG_REVIEW = 5.0
ARRIVAL_FALLBACK_DAYS = 30

# --- fixed values: gift unit costs (A breakfast per person-night, B upgrade as a
# share of the stay price, C parking per night, D spa per person) -------------
GIFT_UNIT_COSTS = {"A": 4.0, "B": 0.09, "C": 7.0, "D": 9.0}

# --- fixed values: gift display names; the no-gift row has its own label -----
GIFT_NAMES = {"A": "Desayuno", "B": "Mejora habitación", "C": "Parking", "D": "Spa"}
NO_GIFT_NAME = "Sin regalo (bajo riesgo o no rentable)"

# --- fixed values: board codes that already include meals (gift A needs none) --
MEAL_BOARDS = ["BB", "FB", "HB"]

# --- fixed values: replacement-rate factors ------------------------------------
REPLACEMENT_WEEKEND_DAYS = [3, 4, 5]      # Thu, Fri, Sat with Monday = 0
REPLACEMENT_SHORT_STAY = (1, 3)
TIME_FACTOR_SHORT_WEEKEND = 0.50
TIME_FACTOR_OTHER = 0.35
HOTEL_FACTOR_CITY = 0.70
HOTEL_FACTOR_OTHER = 0.55
REVIEW_FACTOR_SCALE = 0.20

# --- fixed values: gift success probabilities -----------------------------------
SUCCESS_A_DIVISOR = 4.0
SUCCESS_B_CITY, SUCCESS_B_OTHER = 0.80, 0.65
SUCCESS_C = 0.50
SUCCESS_D_RESORT, SUCCESS_D_OTHER = 0.70, 0.55

# --- fixed values: probability segments of the campaign report (first lower
# bound is the decision threshold) ---------------------------------------------
SEGMENT_UPPER_BOUNDS = [0.6, 0.7, 0.8, 0.9, 1.0]

# --- fixed values: unknown continent label -----------------------------------
UNKNOWN_CONTINENT = "Desconocido"

# --- fixed values: country code -> continent used in training (61 codes) ------
CONTINENT_MAP_TRAINING = {
    "SPA": "Europa", "FRA": "Europa", "POR": "Europa", "AUT": "Europa",
    "NLD": "Europa", "ITA": "Europa", "GBR": "Europa", "DEU": "Europa",
    "DNK": "Europa", "POL": "Europa", "BEL": "Europa", "FIN": "Europa",
    "NOR": "Europa", "HUN": "Europa", "CHE": "Europa", "ROU": "Europa",
    "SWE": "Europa", "UKR": "Europa", "GRC": "Europa", "IRL": "Europa",
    "JPN": "Asia", "ISR": "Asia", "CHN": "Asia", "IND": "Asia",
    "IRN": "Asia", "IRQ": "Asia", "PHL": "Asia", "MYS": "Asia",
    "SGP": "Asia", "TWN": "Asia", "THA": "Asia", "KOR": "Asia",
    "AGO": "África", "CMR": "África", "DZA": "África", "EGY": "África",
    "MAR": "África", "ZAF": "África", "MOZ": "África", "TUN": "África",
    "USA": "América del Norte", "MEX": "América del Norte", "CAN": "América del Norte",
    "CUB": "América del Norte", "DOM": "América del Norte", "PRI": "América del Norte",
    "BRA": "América del Sur", "ARG": "América del Sur", "ECU": "América del Sur",
    "COL": "América del Sur", "PER": "América del Sur", "URY": "América del Sur",
    "VEN": "América del Sur", "CHL": "América del Sur", "BOL": "América del Sur",
    "AUS": "Oceanía", "NZL": "Oceanía", "PYF": "Oceanía", "NCL": "Oceanía", "FJI": "Oceanía",
    "CN": "Otros",
}

# --- fixed values: the shorter mapping shipped with the older scoring code ----
CONTINENT_MAP_SCORING = {
    "SPA": "Europa", "FRA": "Europa", "POR": "Europa",
    "USA": "América del Norte", "MEX": "América del Norte",
    "BRA": "América del Sur", "ARG": "América del Sur",
    "CHN": "Asia", "JPN": "Asia",
    "AUS": "Oceanía", "NZL": "Oceanía",
}

# --- fixed values: feature-engineering bands ------------------------------------
LEAD_TIME_EDGES = [-1, 7, 30, 90, 180]          # right-closed bins, last open-ended
LEAD_TIME_LABELS = ["last_minute", "short", "medium", "long", "very_long"]
STAY_EDGES = [-1, 1, 3, 7, 14]
STAY_LABELS = ["1_night", "2-3_nights", "4-7_nights", "8-14_nights", "15+_nights"]
PRICE_LABELS = ["very_low", "low", "medium", "high", "very_high"]
BOOKING_WEEKEND_DAYS = [5, 6]
ARRIVAL_WEEKEND_DAYS = [4, 5]
HIGH_SEASON_MONTHS = [6, 7, 8, 12]
SUMMER_MONTHS = [6, 7, 8]
WINTER_MONTHS = [12, 1, 2]
AMENITY_COLUMNS = ["pool_and_spa", "restaurant", "parking"]

# --- fixed values: modelling defaults -------------------------------------------
LATE_CANCEL_DAYS = 30
IQR_FACTOR = 1.5
QUANTILE_LOW, QUANTILE_HIGH = 0.05, 0.95
KNN_NEIGHBORS = 5
SMOTE_RATIO = 0.8
POSITIVE_CLASS_WEIGHT = 1.5
GROUP_FOLDS = 7
SEED = 42
VARIANCE_THRESHOLD = 0.001
ANOVA_TOP_K = 22
TEST_FRACTION = 0.2
GRID_START, GRID_STOP, GRID_STEP = 0.3, 0.7, 0.01          # threshold grid (arange)
SWEEP_START, SWEEP_STOP, SWEEP_NUM = 0.1, 0.8, 40           # threshold sweep (linspace)
