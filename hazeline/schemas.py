"""Table schemas and the fixed values that scoring and reporting rest on."""

from pyspark.sql import types as T

CITY = "city"
TIME = "timestamp"
TARGET = "aqi"

#: Order of the six pollutant columns, all in micrograms per cubic metre.
POLLUTANTS = ("pm2_5", "pm10", "no2", "so2", "o3", "co")
MEASURES = POLLUTANTS + (TARGET,)
CORE_COLUMNS = (CITY, TIME, TARGET) + POLLUTANTS

READINGS = T.StructType(
    [
        T.StructField(CITY, T.StringType()),
        T.StructField(TIME, T.TimestampType()),
        T.StructField(TARGET, T.IntegerType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in POLLUTANTS]
)

FORECAST = T.StructType(
    [
        T.StructField(CITY, T.StringType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField(TIME, T.TimestampType()),
        T.StructField(TARGET, T.DoubleType()),
    ]
)

ATTRIBUTIONS = T.StructType(
    [
        T.StructField(CITY, T.StringType()),
        T.StructField(TIME, T.TimestampType()),
        T.StructField("feature", T.StringType()),
        T.StructField("phi", T.DoubleType()),
    ]
)

#: One vendor payload: a list of hourly entries, each with a coarse 1..5 index,
#: the component concentrations and an epoch-seconds stamp.
PAYLOAD = T.StructType(
    [
        T.StructField(
            "list",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("main", T.StructType([T.StructField("aqi", T.IntegerType())])),
                        T.StructField(
                            "components",
                            T.StructType([T.StructField(name, T.DoubleType()) for name in POLLUTANTS]),
                        ),
                        T.StructField("dt", T.LongType()),
                    ]
                )
            ),
        )
    ]
)

# --- fixed values -----------------------------------------------------------
# EPA breakpoints: (concentration low, high, index low, high). The closed
# brackets leave gaps; a value in a gap, below or above scores ``overflow``.
# ``divisors`` turn micrograms per cubic metre into the table's unit, applied in
# order; ``step`` is the precision the brackets are published with.
BREAKPOINTS = {
    "pm2_5": dict(
        divisors=(),
        overflow=500,
        step=0.1,
        brackets=[
            (0.0, 12.0, 0, 50),
            (12.1, 35.4, 51, 100),
            (35.5, 55.4, 101, 150),
            (55.5, 150.4, 151, 200),
            (150.5, 250.4, 201, 300),
            (250.5, 350.4, 301, 400),
            (350.5, 500.4, 401, 500),
        ],
    ),
    "pm10": dict(
        divisors=(),
        overflow=500,
        step=1.0,
        brackets=[
            (0, 54, 0, 50),
            (55, 154, 51, 100),
            (155, 254, 101, 150),
            (255, 354, 151, 200),
            (355, 424, 201, 300),
            (425, 504, 301, 400),
            (505, 604, 401, 500),
        ],
    ),
    "no2": dict(
        divisors=(1.88,),
        overflow=500,
        step=1.0,
        brackets=[
            (0, 53, 0, 50),
            (54, 100, 51, 100),
            (101, 360, 101, 150),
            (361, 649, 151, 200),
            (650, 1249, 201, 300),
            (1250, 1649, 301, 400),
            (1650, 2049, 401, 500),
        ],
    ),
    "o3": dict(
        divisors=(1.96,),
        overflow=300,
        step=1.0,
        brackets=[
            (0, 54, 0, 50),
            (55, 70, 51, 100),
            (71, 85, 101, 150),
            (86, 105, 151, 200),
            (106, 200, 201, 300),
        ],
    ),
    "so2": dict(
        divisors=(2.62,),
        overflow=500,
        step=1.0,
        brackets=[
            (0, 35, 0, 50),
            (36, 75, 51, 100),
            (76, 185, 101, 150),
            (186, 304, 151, 200),
            (305, 604, 201, 300),
            (605, 804, 301, 400),
            (805, 1004, 401, 500),
        ],
    ),
    "co": dict(
        divisors=(1000.0, 1.145),
        overflow=500,
        step=0.1,
        brackets=[
            (0, 4.4, 0, 50),
            (4.5, 9.4, 51, 100),
            (9.5, 12.4, 101, 150),
            (12.5, 15.4, 151, 200),
            (15.5, 30.4, 201, 300),
            (30.5, 40.4, 301, 400),
            (40.5, 50.4, 401, 500),
        ],
    ),
}

# Health categories: (upper limit, name, colour, tint, icon, message).
CATEGORIES = [
    (50, "Good", "#00E400", "rgba(0,228,0,0.12)", "🟢",
     "Air quality is satisfactory and poses little or no risk. Enjoy outdoor activities freely."),
    (100, "Moderate", "#D4B800", "rgba(255,215,0,0.12)", "🟡",
     "Air quality is acceptable. Unusually sensitive individuals should consider reducing prolonged outdoor exertion."),
    (150, "Unhealthy for Sensitive Groups", "#FF7E00", "rgba(255,126,0,0.12)", "🟠",
     "Sensitive groups may experience health effects. The general public is not likely to be affected."),
    (200, "Unhealthy", "#FF0000", "rgba(255,0,0,0.12)", "🔴",
     "Everyone may begin to experience health effects. Limit prolonged outdoor exertion."),
    (300, "Very Unhealthy", "#8F3F97", "rgba(143,63,151,0.12)", "🟣",
     "Health alert — everyone may experience serious health effects. Wear N95 masks if going outside."),
    (999, "Hazardous", "#7E0023", "rgba(126,0,35,0.12)", "⛔",
     "🚨 Emergency conditions. Stay indoors, seal windows, use air purifiers."),
]

# Guideline concentrations that the pollutant bars are measured against.
GUIDELINES = {"pm2_5": 75.0, "pm10": 150.0, "no2": 100.0, "so2": 75.0, "o3": 100.0, "co": 4.0}

# Local clock of the reports.
LOCAL_ZONE = "Asia/Karachi"
# --- end of fixed values ----------------------------------------------------
