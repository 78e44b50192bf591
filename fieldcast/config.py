"""Thresholds, calendars and lookup values, all passed to operators as defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SeasonRule:
    """Onset rule of one crop season: value ranges and the date window searched."""

    temp_min: float
    temp_max: float
    rain_min: float
    humidity_min: float
    humidity_max: float
    window_start: tuple[int, int]
    window_end: tuple[int, int]
    official_start: tuple[int, int]
    months: tuple[int, ...]
    crops: str


# Season rules, windows and crop lists.
SEASON_RULES: dict[str, SeasonRule] = {
    "Kharif": SeasonRule(27, 30, 0.20, 72, 85, (5, 15), (6, 15), (6, 1),
                         (6, 7, 8, 9), "Rice, Maize, Soybean, Cotton"),
    "Rabi": SeasonRule(20, 25, 0.01, 55, 70, (10, 1), (10, 31), (10, 15),
                       (10, 11, 12, 1, 2), "Wheat, Mustard, Chickpea, Barley"),
    "Zaid": SeasonRule(28, 31, 0.02, 45, 65, (2, 20), (3, 20), (3, 1),
                       (3, 4, 5), "Moong, Watermelon, Cucumber, Groundnut"),
}

# Month lists of the four season calendars in use.
CALENDARS: dict[str, dict[str, tuple[int, ...]]] = {
    "gold": {"Kharif": (6, 7, 8, 9), "Rabi": (10, 11, 12, 1, 2), "Zaid": (3, 4, 5)},
    "ml": {"Kharif": (6, 7, 8, 9, 10), "Rabi": (11, 12, 1, 2, 3), "Zaid": (4, 5)},
    "met": {"Winter": (12, 1, 2), "Summer": (3, 4, 5), "Monsoon": (6, 7, 8, 9),
            "Post-Monsoon": (10, 11)},
    "up": {"Winter": (12, 1, 2), "Zaid": (3, 4, 5), "Kharif": (6, 7, 8, 9),
           "Rabi": (10, 11)},
}

# Penalties per unit of the suitability scores.
RANGE_PENALTY = 8.0
RAIN_PENALTY = 40.0

# Renewable scoring.
WIND_10M_MAX = 20.0
WIND_100M_MAX = 30.0
CLOUD_EXPONENT = 1.3
DAY_LENGTH_SWING = 0.15
DAY_LENGTH_RADIANS = 2 * 3.14159 / 12
WIND_SHARE, SOLAR_SHARE = 0.6, 0.4
ENERGY_MARGIN = 10.0

# Crop matching (weather column, crop column, default weight).
MATCH_FEATURES: tuple[tuple[str, str, float], ...] = (
    ("avg_temperature_2m", "Temperature_C", 0.30),
    ("avg_humidity", "Humidity_%", 0.20),
    ("season_rainfall", "Rainfall_mm", 0.30),
    ("avg_wind_speed_10m", "Wind_Speed_m_s", 0.10),
    ("solar_proxy", "Solar_Radiation_MJ_m2_day", 0.10),
)
VIABLE_SCORE = 60
CONFIDENT_DAYS = 60
TOP_CROPS = 5
YIELD_HIGH, YIELD_MEDIUM = 3000, 1500

# Defaults when neither a reading nor a state average exists.
DEFAULT_TEMPERATURE, DEFAULT_HUMIDITY, DEFAULT_PH = 25.0, 65.0, 6.8

# State spellings and macro regions.
STATE_RENAMES = {
    "Orissa": "Odisha",
    "Uttaranchal": "Uttarakhand",
    "Andaman and Nicobar": "Andaman & Nicobar",
    "Jammu and Kashmir": "Jammu & Kashmir",
}
REGION_STATES: dict[str, tuple[str, ...]] = {
    "North": ("Jammu & Kashmir", "Jammu and Kashmir", "Ladakh", "Himachal Pradesh",
              "Punjab", "Chandigarh", "Uttarakhand", "Uttaranchal", "Haryana", "Delhi",
              "Rajasthan", "Uttar Pradesh"),
    "Central": ("Madhya Pradesh", "Chhattisgarh"),
    "East": ("Bihar", "Jharkhand", "West Bengal", "Odisha", "Orissa", "Assam", "Sikkim",
             "Arunachal Pradesh", "Nagaland", "Manipur", "Mizoram", "Tripura", "Meghalaya"),
    "West": ("Gujarat", "Maharashtra", "Goa", "Dadra and Nagar Haveli and Daman and Diu",
             "Dadra and Nagar Haveli", "Daman and Diu"),
    "South": ("Andhra Pradesh", "Telangana", "Karnataka", "Tamil Nadu", "Kerala",
              "Puducherry", "Lakshadweep", "Andaman & Nicobar", "Andaman and Nicobar"),
}
# Regions by squeezed state name, used with the coordinate fallback.
COORDINATE_REGION_STATES: dict[str, tuple[str, ...]] = {
    "North": ("jammuandkashmir", "ladakh", "himachalpradesh", "punjab", "haryana",
              "chandigarh", "delhi", "uttarakhand", "uttarpradesh"),
    "Northeast": ("assam", "arunachalpradesh", "manipur", "meghalaya", "mizoram",
                  "nagaland", "tripura", "sikkim"),
    "East": ("bihar", "jharkhand", "odisha", "westbengal"),
    "Central": ("madhyapradesh", "chhattisgarh"),
    "West": ("rajasthan", "gujarat", "maharashtra", "goa"),
    "South": ("andhrapradesh", "telangana", "karnataka", "kerala", "tamilnadu",
              "puducherry"),
}
# Soil pH class by state.
SOIL_PH_STATES: dict[float, tuple[str, ...]] = {
    7.4: ("Maharashtra", "Madhya Pradesh", "Gujarat", "Andhra Pradesh", "Telangana"),
    6.8: ("Punjab", "Haryana", "Uttar Pradesh", "Bihar", "Delhi", "Chandigarh",
          "Puducherry"),
    8.1: ("Rajasthan",),
    6.3: ("Chhattisgarh", "Jharkhand", "West Bengal", "Tamil Nadu"),
    5.8: ("Kerala", "Assam", "Odisha", "Orissa", "Karnataka", "Himachal Pradesh",
          "Uttarakhand", "Uttaranchal", "Jammu & Kashmir", "Jammu and Kashmir", "Ladakh",
          "Sikkim", "Arunachal Pradesh", "Manipur", "Meghalaya", "Mizoram", "Nagaland",
          "Tripura", "Goa", "Dadra and Nagar Haveli and Daman and Diu",
          "Dadra and Nagar Haveli", "Daman and Diu", "Andaman & Nicobar",
          "Andaman and Nicobar", "Lakshadweep"),
}

# Raw header aliases of the hourly files.
COLUMN_ALIASES: dict[str, tuple[str, ...]] = {
    "time": ("time", "datetime", "date"),
    "temperature_2m": ("temperature2m", "temp2m", "temperature"),
    "relative_humidity_2m": ("relativehumidity2m", "humidity2m", "relativehumidity"),
    "dew_point_2m": ("dewpoint2m", "dewpoint"),
    "precipitation": ("precipitation", "precip"),
    "rain": ("rain",),
    "cloud_cover": ("cloudcover", "cloudiness"),
    "cloud_cover_low": ("cloudcoverlow", "lowcloudcover"),
    "cloud_cover_mid": ("cloudcovermid", "midcloudcover"),
    "cloud_cover_high": ("cloudcoverhigh", "highcloudcover"),
    "wind_speed_10m": ("windspeed10m", "wind10m"),
    "wind_speed_100m": ("windspeed100m", "wind100m"),
    "wind_gusts_10m": ("windgusts10m", "windgust10m", "windgusts"),
    "pressure_msl": ("pressuremsl", "sealevelpressure"),
    "surface_pressure": ("surfacepressure",),
}

# Columns of the hourly fact.
HOURLY_MEASURES: tuple[str, ...] = (
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
    "precipitation", "rain", "snowfall", "snow_depth", "pressure_msl",
    "surface_pressure", "cloud_cover", "cloud_cover_low", "cloud_cover_mid",
    "cloud_cover_high", "wind_speed_10m", "wind_speed_100m", "wind_direction_10m",
    "wind_direction_100m", "wind_gusts_10m",
)
REQUIRED_FACT_COLUMNS: tuple[str, ...] = (
    "city_id", "date", "temperature_2m", "relative_humidity_2m", "precipitation", "rain",
    "pressure_msl", "cloud_cover", "wind_speed_10m", "wind_speed_100m",
)
HOURLY_FILE_SCHEMA: tuple[tuple[str, str], ...] = (
    ("date", "string"), *((m, "double") for m in HOURLY_MEASURES), ("city", "string"),
)

# Base crops (temperature C, rain mm, humidity %, pH, yield kg/ha, seasons).
BASE_CROPS: tuple[tuple, ...] = (
    ("rice", 26.0, 1100.0, 78.0, 6.5, 2400.0, ("kharif", "monsoon")),
    ("wheat", 19.0, 550.0, 58.0, 6.8, 3100.0, ("rabi", "winter")),
    ("maize", 24.0, 750.0, 65.0, 6.5, 2800.0, ("kharif", "monsoon", "rabi", "zaid")),
    ("chickpea", 20.0, 450.0, 55.0, 7.0, 1100.0, ("rabi", "winter")),
    ("cotton", 28.0, 700.0, 62.0, 7.4, 1800.0, ("kharif", "monsoon")),
    ("sugarcane", 30.0, 1500.0, 75.0, 7.0, 70000.0, ("whole year", "kharif", "rabi", "zaid")),
    ("groundnut", 27.0, 650.0, 60.0, 6.8, 1700.0, ("kharif", "monsoon", "zaid")),
    ("mustard", 18.0, 400.0, 52.0, 7.0, 1300.0, ("rabi", "winter")),
    ("soybean", 26.0, 850.0, 70.0, 6.5, 1400.0, ("kharif", "monsoon")),
    ("banana", 29.0, 1800.0, 80.0, 6.8, 38000.0, ("whole year", "kharif", "rabi", "zaid")),
    ("mango", 31.0, 1200.0, 65.0, 6.5, 8500.0, ("whole year", "summer", "zaid")),
    ("potato", 17.0, 500.0, 60.0, 5.8, 22000.0, ("rabi", "winter")),
    ("onion", 21.0, 600.0, 58.0, 6.8, 16000.0, ("rabi", "winter", "kharif")),
    ("garlic", 18.0, 450.0, 55.0, 6.5, 5200.0, ("rabi", "winter")),
    ("ginger", 27.0, 1600.0, 80.0, 6.0, 4800.0, ("kharif", "monsoon")),
    ("turmeric", 28.0, 1500.0, 78.0, 6.2, 5100.0, ("kharif", "monsoon")),
    ("jute", 30.0, 1400.0, 82.0, 6.5, 2200.0, ("kharif", "monsoon")),
    ("sunflower", 25.0, 600.0, 58.0, 7.0, 950.0, ("rabi", "zaid")),
    ("barley", 16.0, 400.0, 50.0, 7.2, 2600.0, ("rabi", "winter")),
    ("bajra", 32.0, 350.0, 45.0, 7.8, 1200.0, ("kharif", "monsoon", "zaid")),
    ("jowar", 30.0, 400.0, 50.0, 7.6, 1000.0, ("kharif", "monsoon", "rabi")),
    ("ragi", 25.0, 700.0, 65.0, 6.5, 1500.0, ("kharif", "monsoon")),
    ("black pepper", 28.0, 2200.0, 85.0, 5.8, 350.0, ("whole year", "kharif")),
    ("cardamom", 22.0, 2500.0, 88.0, 5.5, 250.0, ("whole year", "kharif")),
    ("cashewnut", 29.0, 1300.0, 72.0, 6.0, 750.0, ("whole year", "summer")),
    ("coconut", 28.0, 1600.0, 80.0, 6.5, 9000.0, ("whole year", "kharif", "rabi", "zaid")),
)
# Spreads and nutrient needs shared by all base crops.
CROP_SPREAD = {"temp": 3.0, "humidity": 8.0, "rainfall": 150.0, "ph": 0.5}
CROP_SPREAD_FLOOR = {"temp": 1.5, "humidity": 3.0, "rainfall": 50.0}
CROP_NPK = (20.0, 10.0, 15.0)
CROP_FALLBACK = {"temp": 25.0, "humidity": 65.0, "rainfall": 800.0, "ph": 6.8,
                 "yield": 1200.0}
# Distance weights with and without recency, decay, penalty.
SUITABILITY_WEIGHTS = {
    True: {"temp": 0.40, "rain": 0.35, "humidity": 0.15, "ph": 0.10},
    False: {"temp": 0.35, "rain": 0.35, "humidity": 0.20, "ph": 0.10},
}
DISTANCE_FACTOR = 0.35
OUT_OF_SEASON_FACTOR = 0.45
RECENCY_DECAY = 0.85
DEFAULT_CLIMATE = (26.0, 850.0, 68.0, 6.8)

# Zone names with the crops advised for them.
ZONES: dict[str, tuple[str, str]] = {
    "driest": ("Hot & Arid Zone",
               "Kharif: Bajra, Jowar, Groundnut, Sesame | Rabi: Mustard, Chickpea"),
    "wettest": ("Humid High-Rainfall Zone",
                "Kharif: Rice, Jute, Tea, Rubber | Rabi: Boro Rice, Pulses"),
    "hot": ("Semi-Arid Central Plateau",
            "Kharif: Cotton, Soybean, Pulses | Rabi: Wheat, Sunflower"),
    "cool": ("Sub-Humid Fertile Plains",
             "Kharif: Rice, Maize, Sugarcane | Rabi: Wheat, Mustard, Chickpea"),
    "other": ("Coastal / Tropical Zone",
              "Kharif: Rice, Coconut, Spices | Rabi: Groundnut, Sugarcane"),
}
ZONE_HOT_KHARIF, ZONE_COOL_RABI = 29.0, 18.0
ZONE_FEATURES: tuple[str, ...] = (
    "kharif_temp", "rabi_temp", "zaid_temp", "kharif_rainfall", "rabi_rainfall",
    "avg_humidity", "temp_range",
)

# Text chunking.
CHUNK_SIZE, CHUNK_OVERLAP = 600, 80
CHUNK_SEPARATORS: tuple[str, ...] = ("\n## ", "\n### ", "\n\n", "\n", " ")

# Sampling.
SAMPLE_SHARE, SAMPLE_FLOOR, SAMPLE_SEED = 0.30, 15, 42
