"""Fixture values from the reference's examples and doc comments (FIXTURES.md)."""

# Example source lines (measurement sensor, tag sid, 8 fields, no time).
SOURCE_LINES = [
    "sensor,sid=1 pm25_aqi=1,pm10_aqi=72,no2_aqi=31,temperature=-1,pressure=925,humidity=46,wind=4,weather=2",
    "sensor,sid=1 pm25_aqi=2,pm10_aqi=75,no2_aqi=31,temperature=-1,pressure=924,humidity=47,wind=4,weather=2",
    "sensor,sid=1 pm25_aqi=3,pm10_aqi=100,no2_aqi=31,temperature=-1,pressure=928,humidity=48,wind=4,weather=2",
    "sensor,sid=1 pm25_aqi=4,pm10_aqi=200,no2_aqi=31,temperature=-1,pressure=929,humidity=99,wind=4,weather=2",
    "sensor,sid=1 pm25_aqi=20,pm10_aqi=210,no2_aqi=32,temperature=2,pressure=945,humidity=86,wind=4,weather=5",
    "sensor,sid=1 pm25_aqi=23,pm10_aqi=200,no2_aqi=32,temperature=1,pressure=915,humidity=16,wind=6,weather=4",
    "sensor,sid=1 pm25_aqi=24,pm10_aqi=200,no2_aqi=32,temperature=2,pressure=885,humidity=98,wind=6,weather=5",
    "sensor,sid=1 pm25_aqi=25,pm10_aqi=100,no2_aqi=33,temperature=4,pressure=785,humidity=29,wind=6,weather=4",
]

# Example sink lines (with ns time, 1 s apart).
SINK_LINES = [
    "sensor,sid=1 pm25_aqi=1,pm10_aqi=72,no2_aqi=31,temperature=-1,pressure=925,humidity=46,wind=4,weather=2 1723456926000000000",
    "sensor,sid=1 pm25_aqi=-1,pm10_aqi=74,no2_aqi=33,temperature=0,pressure=625,humidity=86,wind=4,weather=2 1723456927000000000",
    "sensor,sid=1 pm25_aqi=2,pm10_aqi=71,no2_aqi=32,temperature=-5,pressure=985,humidity=76,wind=4,weather=2 1723456928000000000",
    "sensor,sid=1 pm25_aqi=-4,pm10_aqi=70,no2_aqi=34,temperature=4,pressure=885,humidity=100,wind=4,weather=2 1723456929000000000",
    "sensor,sid=1 pm25_aqi=7,pm10_aqi=72,no2_aqi=31,temperature=-1,pressure=925,humidity=96,wind=4,weather=2 1723456930000000000",
]

# The client's write example (no time).
WRITE_EXAMPLE = ("sensor,sid=1 pm25_aqi=101,pm10_aqi=172,no2_aqi=131,temperature=-1,pressure=925,"
                 "humidity=210,wind=4,weather=2")

SENSOR_FIELDS = ["pm25_aqi", "pm10_aqi", "no2_aqi", "temperature", "pressure", "humidity",
                 "wind", "weather"]

# Time documentation examples.
ISO_EXAMPLE = "2023-03-27T06:13:36.725154800Z"
NS_EXAMPLE = 1679897616725154800
NS_SPLIT_EXAMPLE = (1679897616, 725154800)
