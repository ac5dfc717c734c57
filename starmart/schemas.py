"""Declared column types of the input files."""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STR, _INT, _DBL, _DATE = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType()

AIRPORTS = _schema(
    ident=_STR,
    type=_STR,
    name=_STR,
    elevation_ft=_INT,
    continent=_STR,
    iso_country=_STR,
    iso_region=_STR,
    municipality=_STR,
    gps_code=_STR,
    iata_code=_STR,
    local_code=_STR,
    coordinates=_STR,
)

DEMOGRAPHICS = _schema(
    **{
        "City": _STR,
        "State": _STR,
        "Median Age": _DBL,
        "Male Population": _INT,
        "Female Population": _INT,
        "Total Population": _INT,
        "Number of Veterans": _INT,
        "Foreign-born": _INT,
        "Average Household Size": _DBL,
        "State Code": _STR,
        "Race": _STR,
        "Count": _INT,
    }
)

WEATHER = _schema(
    dt=_DATE,
    AverageTemperature=_DBL,
    AverageTemperatureUncertainty=_DBL,
    City=_STR,
    Country=_STR,
    Latitude=_STR,
    Longitude=_STR,
)

ARRIVALS = _schema(
    cicid=_DBL,
    i94yr=_DBL,
    i94mon=_DBL,
    i94cit=_DBL,
    i94res=_DBL,
    i94port=_STR,
    arrdate=_DBL,
    i94mode=_DBL,
    i94addr=_STR,
    depdate=_DBL,
    i94bir=_DBL,
    i94visa=_DBL,
    count=_DBL,
    dtadfile=_STR,
    visapost=_STR,
    occup=_STR,
    entdepa=_STR,
    entdepd=_STR,
    entdepu=_STR,
    matflag=_STR,
    biryear=_DBL,
    dtaddto=_STR,
    gender=_STR,
    insnum=_STR,
    airline=_STR,
    admnum=_DBL,
    fltno=_STR,
    visatype=_STR,
)

# Written by the plans.
AIRPORTS_OUT = T.StructType([field for field in AIRPORTS if field.name != "continent"])

WEATHER_OUT = _schema(
    City=_STR, City_AverageTemperature=_DBL, City_AverageTemperatureUncertainty=_DBL
)


def demographics_out(columns: list[str]) -> T.StructType:
    """Types of the written demographics: known columns as read, race columns as whole numbers."""
    known = {field.name: field.dataType for field in DEMOGRAPHICS}
    return _schema(**{name: known.get(name, T.LongType()) for name in columns})
