"""Declared schemas of the input files and of the output tables.

Schemas are declared on both sides: inference costs a pass over the data and
drifts from file to file. Open-keyed objects are maps, so a file in which no
row has some key still yields the same columns. Ids are strings, so long
numeric ids keep every digit. Date-times carry no zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

from placemill.constants import ATTRIBUTE_KEYS, HOMICIDE_DROPPED, SCALED_FEATURES

STR = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
DBL = T.DoubleType()
BOOL = T.BooleanType()
DATE = T.DateType()
TS = T.TimestampNTZType()


def table(**columns: T.DataType) -> T.StructType:
    """A schema of nullable columns, in the order given."""
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# ---- inputs -----------------------------------------------------------------

STATE_DIM = table(nombre_largo=STR, nombre_corto=STR, codigos=STR)

MAPS_SITES = table(
    gmap_id=STR,
    name=STR,
    address=STR,
    category=T.ArrayType(STR),
    latitude=DBL,
    longitude=DBL,
    avg_rating=DBL,
    price=STR,
    state=STR,
    MISC=T.MapType(STR, T.ArrayType(STR)),
)

MAPS_REVIEWS = table(
    gmap_id=STR,
    user_id=STR,
    time=LONG,
    rating=LONG,
    text=STR,
    resp=table(time=LONG, text=STR),
)

YELP_BUSINESS = table(
    business_id=STR,
    name=STR,
    city=STR,
    state=STR,
    latitude=DBL,
    longitude=DBL,
    stars=DBL,
    categories=STR,
    attributes=T.MapType(STR, STR),
)

YELP_BUSINESS_PLACED = T.StructType(
    YELP_BUSINESS.fields + table(ciudad=STR, estado=STR).fields
)

YELP_REVIEWS = table(
    review_id=STR,
    business_id=STR,
    user_id=STR,
    date=TS,
    stars=LONG,
    useful=LONG,
    funny=LONG,
    cool=LONG,
    text=STR,
)

YELP_TIPS = table(business_id=STR, user_id=STR, date=TS, text=STR, compliment_count=LONG)

HOMICIDES = table(
    Id_hecho=STR,
    FECHA=STR,
    COMUNA=LONG,
    LONGITUD=STR,
    LATITUD=STR,
    **{name: STR for name in HOMICIDE_DROPPED},
)

GAMES = table(game_id=LONG, game_name=STR, genres=STR, release_year=INT)
GAME_REVIEWS = table(game_id=LONG, recommend=BOOL, sentiment_analysis=INT, year=INT)
USER_GENRE = table(user_id=STR, genres=STR, release_year=INT, playtime_forever=LONG)
GAME_MODEL = table(game_id=LONG, game_name=STR, idx=LONG)
SIMILARITY = table(i=LONG, j=LONG, sim=DBL)
GENRE_YEAR = table(genres=STR, release_year=INT, playtime_forever=LONG)
GAZETTEER = table(city=STR, state=STR, latitude=DBL, longitude=DBL)
LOCATION_FEATURES = table(
    state=STR,
    category_name=STR,
    latitude=DBL,
    longitude=DBL,
    **{name: DBL for name in SCALED_FEATURES},
)

# ---- outputs ----------------------------------------------------------------

BUSINESS = table(
    business_id=STR,
    name=STR,
    city=STR,
    state=STR,
    latitude=DBL,
    longitude=DBL,
    stars=DBL,
    price=STR,
    platform=LONG,
)
CATEGORY_BUSINESS = table(business_id=STR, category_name=STR, platform=LONG)
SERVICE_BUSINESS = table(business_id=STR, service_option=STR)
PLANNING_BUSINESS = table(business_id=STR, planning_option=STR)
ATTRIBUTES_BUSINESS = table(business_id=STR, **{key: STR for key in ATTRIBUTE_KEYS})
REVIEWS = table(
    business_id=STR,
    user_id=STR,
    date=TS,
    stars=LONG,
    useful=LONG,
    funny=LONG,
    cool=LONG,
    text=STR,
    platform=LONG,
)
RESP_REVIEWS = table(business_id=STR, time=TS, text=STR)
TIPS = table(business_id=STR, user_id=STR, date=TS, text=STR)
USERS = table(
    user_id=STR,
    name=STR,
    review_count=LONG,
    yelping_since=TS,
    useful=LONG,
    funny=LONG,
    cool=LONG,
    fans=LONG,
    average_stars=DBL,
)
HOMICIDE_FACTS = table(Id_hecho=STR, FECHA=DATE, COMUNA=LONG, LONGITUD=STR, LATITUD=STR)
SITES_SLIM = table(
    gmap_id=STR, name=STR, latitude=DBL, longitude=DBL, avg_rating=DBL, price=STR, state=STR
)

# Output table names and the schema each one is loaded with.
OUTPUT_TABLES = {
    "business": BUSINESS,
    "category_business": CATEGORY_BUSINESS,
    "service_business": SERVICE_BUSINESS,
    "planning_busines": PLANNING_BUSINESS,
    "attributes_business": ATTRIBUTES_BUSINESS,
    "reviews": REVIEWS,
    "resp_reviews": RESP_REVIEWS,
    "tips_yelp": TIPS,
    "users_yelp": USERS,
    "hechos_homicidios": HOMICIDE_FACTS,
    "sitios_gmaps": SITES_SLIM,
    "estados_usa2": STATE_DIM,
}
