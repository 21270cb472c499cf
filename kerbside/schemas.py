"""Topic schemas, key spellings and the small lookup tables of the domain."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


S, D, I, L, B = StringType(), DoubleType(), IntegerType(), LongType(), BooleanType()

POINT = _struct(latitude=D, longitude=D)
COORDINATES = ArrayType(D)

# Topic names and message fields as the producers write them.
VEHICLE_TOPIC = "vehicle_data"
GPS_TOPIC = "gps_data"
TRAFFIC_TOPIC = "traffic_data"
WEATHER_TOPIC = "weather_data"
EMERGENCY_TOPIC = "emergency_data"
ROUTES_TOPIC = "optimized_routes"
ALERTS_TOPIC = "driver_alerts"
METRICS_TOPIC = "driver_performance_metrics"
EVALUATIONS_TOPIC = "driver_performance_evaluations"

#: Message fields per topic. ``location`` is listed with its main shape; the reader also accepts the other.
MESSAGES: dict[str, StructType] = {
    VEHICLE_TOPIC: _struct(
        id=S, deviceId=S, timestamp=S, location=POINT, speed=D, direction=S, make=S, model=S, year=I, fuelType=S,
        auto_braking_supported=B, abs_supported=B, traction_control_supported=B,
    ),
    GPS_TOPIC: _struct(
        id=S, deviceId=S, timestamp=S, speed=D, direction=S, vehicle_type=S, location=COORDINATES, SpeedLimit=D,
    ),
    TRAFFIC_TOPIC: _struct(id=S, deviceId=S, cameraID=S, location=POINT, timestamp=S, snapshot=S),
    WEATHER_TOPIC: _struct(
        id=S, deviceId=S, location=POINT, timestamp=S, temperature=D, weatherCondition=S, windSpeed=D,
        precipitation=D, humidity=I, airQualityIndex=D,
    ),
    EMERGENCY_TOPIC: _struct(
        id=S, deviceId=S, incidentId=S, type=S, timestamp=S, location=POINT, status=S, description=S,
    ),
    ROUTES_TOPIC: _struct(deviceId=S, placeId=S, timestamp=S, SpeedLimit=D),
    ALERTS_TOPIC: _struct(deviceId=S, action=S, target_speed=D, reason=S, ts=L),
    METRICS_TOPIC: _struct(
        deviceId=S, period=S, avg_speed_over_limit=D, overspeed_events=L, max_speed_over_limit=D,
    ),
    EVALUATIONS_TOPIC: _struct(**{
        "index": I, "rating": I, "class": S, "strengths": S, "weaknesses": S,
        "improvement_tips": ArrayType(S), "deviceId": S, "period": S, "ts": L,
    }),
}

#: Other spellings of a field found in the messages; the first non-empty one counts.
SPELLINGS: dict[str, list[str]] = {
    "deviceId": ["deviceId", "deviceID"],
    "vehicle_type": ["vehicle_type", "vehicleType"],
    "cameraID": ["cameraID", "cameraId"],
}

#: Event-time lateness each reader allows, per topic.
WATERMARKS = {
    GPS_TOPIC: "10 seconds",
    ROUTES_TOPIC: "30 seconds",
    VEHICLE_TOPIC: "2 minutes",
    TRAFFIC_TOPIC: "2 minutes",
    WEATHER_TOPIC: "2 minutes",
    EMERGENCY_TOPIC: "2 minutes",
}

SNAPPED_POINTS = ArrayType(_struct(location=POINT, placeId=S, originalIndex=I))
SNAPPED_ANSWER = _struct(snappedPoints=SNAPPED_POINTS)
SPEED_LIMIT_RESPONSE = _struct(speedLimits=ArrayType(_struct(placeId=S, speedLimit=D)))
ADVICE = _struct(action=S, target_speed=D, reason=S, deviceId=S)
EVALUATION_LIST = ArrayType(_struct(**{
    "index": I, "rating": I, "class": S, "strengths": S, "weaknesses": S, "improvement_tips": ArrayType(S),
}))

# Posted speed limits a road can be given (km/h).
POSTED_LIMITS = [30, 40, 50, 60, 80, 90, 100, 120]

# Weather code -> condition label; every other code is "Unknown".
WEATHER_LABELS = {
    0: "Clear sky", 1: "Mainly clear", 2: "Partly cloudy", 3: "Overcast",
    45: "Fog", 48: "Depositing rime fog",
    51: "Light drizzle", 53: "Moderate drizzle", 55: "Dense drizzle",
    61: "Light rain", 63: "Moderate rain", 65: "Heavy rain",
    71: "Light snow", 73: "Moderate snow", 75: "Heavy snow",
    95: "Thunderstorms", 96: "Thunderstorm with light hail", 99: "Thunderstorm with heavy hail",
}

# Condition label -> (typical temperature, road condition); every other label is "Normal".
ROAD_CONDITIONS = {
    "Clear sky": (22, "Normal"), "Fog": (5, "Low-visibility"), "Heavy Rain": (12, "Wet"),
    "Snow": (-1, "Snow-covered"), "Ice": (-3, "Icy"),
}

# Conditions a weather record takes when no observation is at hand.
FALLBACK_CONDITIONS = ["Sunny", "Cloudy", "Rain", "Snow"]

# Start and end of the sample journey (latitude, longitude), cut into 100 steps.
JOURNEY_START = (51.5074, -0.1278)
JOURNEY_END = (52.4862, -1.8904)

# Capability rows a vehicle can have (make, model, year, auto braking, ABS, traction control).
CAPABILITIES = [
    ("Tesla", "Model 3", 2023, True, True, True),
    ("Lada", "2107", 1987, False, False, False),
    ("Toyota", "Corolla", 2015, False, True, True),
    ("BMW", "X5", 2022, True, True, True),
]

#: Our reading of "risky weather": any of these words in the condition label (case-insensitive).
RISKY_WEATHER = "fog|rain|drizzle|snow|ice|thunder|hail"
