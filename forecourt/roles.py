"""Column roles of the hourly station tables.

The names below are fixed values: the input files use them as headers.
"""

# Target columns, fuel in litres per hour, shop in roubles per hour.
FUEL_TARGETS = [
    "sales_AI92",
    "sales_AI95",
    "sales_AI98",
    "sales_DT_EURO",
    "sales_DT_TANEKO",
    "sales_DT_SUMMER",
    "sales_DT_WINTER",
]
SHOP_TARGETS = [
    "shop_drinks",
    "shop_snacks",
    "shop_car_goods",
    "shop_coffee",
    "shop_tobacco",
]
TARGETS = FUEL_TARGETS + SHOP_TARGETS

# Headers of the source files that get an ASCII name on read.
SOURCE_RENAMES = {
    "shop_напитки": "shop_drinks",
    "shop_закуски": "shop_snacks",
    "shop_автотовары": "shop_car_goods",
    "shop_кофе": "shop_coffee",
    "shop_табак": "shop_tobacco",
}

# Sentinels that replace nulls.
NO_HOLIDAY = "нет_праздника"
NO_ADVERT = "нет_рекламы"
FILL_VALUES = {"holiday_name": NO_HOLIDAY, "ad_channel": NO_ADVERT}

# Columns that other columns already determine.
REDUNDANT = [
    "station_name",
    "total_pumps",
    "total_fuel_sales",
    "shop_total_revenue",
    "total_traffic",
    "quarter",
    "day_name",
]

GRADES = ["AI92", "AI95", "AI98", "DT_EURO", "DT_TANEKO", "DT_SUMMER", "DT_WINTER"]
PRICES = [f"price_{g}" for g in GRADES]
BASE_PRICES = [f"base_price_{g}" for g in GRADES]
PUMPS = [f"num_pumps_{g}" for g in GRADES]

# Constant within a station, so z-scores are undefined for them.
UNSCALED = PRICES

# Passport attributes.
SERVICES = ["has_car_wash", "has_tire_service", "has_cafe", "has_hotel", "has_shop"]
SCORES = [
    "customer_loyalty_score",
    "staff_quality_score",
    "staff_engagement_score",
    "corporate_customer_ratio",
]
STATIC_REALS = (
    ["distance_to_city_km", "shop_area_m2"]
    + PUMPS
    + SERVICES
    + ["competitors_within_5km"]
    + SCORES
    + BASE_PRICES
)
STATIC_CATEGORIES = ["road_type", "direction", "settlement_size"]
PROFILE_ATTRIBUTES = (
    ["road_type", "direction", "distance_to_city_km", "total_pumps", "competitors_within_5km"]
    + SCORES
)

# Measures known or set ahead of time.
FUTURE_CATEGORIES = ["season", "weather_condition", "ad_channel", "holiday_name"]
CALENDAR = ["hour", "day_of_week", "week_of_year", "month"]
CYCLE_PERIODS = {"hour": 24, "day_of_week": 7, "month": 12, "week_of_year": 52}
CALENDAR_FLAGS = ["is_weekend", "is_holiday", "is_rush_hour", "is_night", "is_shop_open"]
PROMOTIONS = ["promotion_fuel_active", "promotion_shop_active", "promotion_cafe_active"]
WEATHER_REALS = ["temperature", "precipitation_mm", "visibility_km", "wind_speed_ms"]
WEATHER_FLAGS = ["is_snow", "is_rain", "is_fog"]
TRAFFIC = [
    "traffic_Passengers_cars",
    "traffic_Truck_short",
    "traffic_Truck",
    "traffic_Truck_long",
    "traffic_Transporter",
    "traffic_Undefined",
]
TRUCKS = ["traffic_Truck_short", "traffic_Truck", "traffic_Truck_long"]
RIVAL_PRICES = ["competitor_price_AI92", "competitor_price_AI95", "competitor_price_DT"]
FUTURE_REALS = (
    [c + s for c in CALENDAR for s in ("", "_sin", "_cos")]
    + CALENDAR_FLAGS
    + PROMOTIONS
    + ["ad_active"]
    + PRICES
    + WEATHER_REALS
    + WEATHER_FLAGS
    + TRAFFIC
    + RIVAL_PRICES
)
PAST_REALS = []

ROLES = {
    "targets": TARGETS,
    "static_categories": [c + "_enc" for c in STATIC_CATEGORIES],
    "static_reals": STATIC_REALS,
    "future_categories": [c + "_enc" for c in FUTURE_CATEGORIES],
    "future_reals": FUTURE_REALS,
    "past_reals": PAST_REALS,
}

# Competitor price, own price, ratio column.
PRICE_RATIOS = {
    "comp_ratio_AI92": ("competitor_price_AI92", ["price_AI92"]),
    "comp_ratio_AI95": ("competitor_price_AI95", ["price_AI95"]),
    "comp_ratio_DT": ("competitor_price_DT", ["price_DT_EURO", "price_DT_TANEKO"]),
}

# Factors of the large correlation table, and the factor groups.
FACTORS = (
    ["temperature", "precipitation_mm", "wind_speed_ms", "visibility_km"]
    + ["total_traffic", "shop_total_revenue"]
    + PROMOTIONS
    + ["ad_active", "is_holiday", "is_weekend", "is_rush_hour", "is_night"]
    + RIVAL_PRICES
)
FACTOR_GROUPS = {
    "traffic": TRAFFIC + ["total_traffic"],
    "weather": ["temperature", "precipitation_mm", "wind_speed_ms", "visibility_km"]
    + ["is_rain", "is_snow", "is_fog"],
    "prices": PRICES + list(PRICE_RATIOS),
    "promotions": PROMOTIONS
    + ["ad_active", "is_holiday", "is_weekend", "is_rush_hour", "is_night"],
    "shop": SHOP_TARGETS + ["shop_total_revenue"],
}

# Calendar split, window lengths and quantile levels.
TRAIN_END = "2023-10-31 23:00:00"
VAL_END = "2023-11-30 23:00:00"
TEST_START = "2023-12-01 00:00:00"
TEST_END = "2023-12-31 23:00:00"
ENCODER_HOURS = 168
MIN_ENCODER_HOURS = 84
HORIZON_HOURS = 24
QUANTILES = [0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98]
QUANTILE_NAMES = ["q02", "q10", "q25", "q50", "q75", "q90", "q98"]
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
SHOP_HOURS = (5, 21)
SEASONS = ["winter", "spring", "summer", "autumn"]

# Weather presets of the what-if scenarios.
WEATHER_PRESETS = {
    "normal": (-5.0, 0.5, 8.0, 3.0, 0, 0, 0),
    "frost": (-20.0, 0.0, 15.0, 5.0, 0, 0, 0),
    "snowfall": (-3.0, 8.0, 2.0, 4.0, 1, 0, 0),
    "thaw": (2.0, 3.0, 6.0, 4.0, 0, 1, 0),
}
PRESET_FIELDS = WEATHER_REALS + WEATHER_FLAGS
DEFAULT_PRESET = "normal"

# First and last day of the interpretation periods.
PERIODS = {
    "test": ("2023-12-01", "2023-12-10"),
    "validation": ("2023-11-01", "2023-11-30"),
    "q4": ("2023-10-01", "2023-12-31"),
    "year": ("2023-01-08", "2023-12-31"),
}

# Training log tags, best first.
TRAIN_TAGS = ["train_loss_step", "train_loss_epoch", "train_loss"]
VAL_TAG = "val_loss"
