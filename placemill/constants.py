"""Fixed values that decide results: labels, word lists and key names."""

# Text that stands in for missing data.
NO_DATA = "SIN DATO"
NO_ATTRIBUTE = "None"

# Source platform codes.
PLATFORM_MAPS = 1
PLATFORM_YELP = 2

# The states whose places are kept.
STATES = ("Florida", "Pennsylvania", "Tennessee", "California", "Texas", "New York")

# Category labels that mark a restaurant on each platform.
MAPS_RESTAURANT = "Restaurant"
YELP_RESTAURANT = "Restaurants"

# Option groups of a Maps place that become child tables.
SERVICE_KEY = "Service options"
PLANNING_KEY = "Planning"

# Attributes kept for a Yelp place, in output order.
ATTRIBUTE_KEYS = (
    "RestaurantsDelivery",
    "OutdoorSeating",
    "BusinessAcceptsCreditCards",
    "GoodForKids",
    "RestaurantsPriceRange2",
    "RestaurantsTakeOut",
    "RestaurantsReservations",
    "HasTV",
)

# Review years kept, both ends included.
FIRST_YEAR = 2010
LAST_YEAR = 2021

# Columns read from homicide files and not kept.
HOMICIDE_DROPPED = (
    "N_VICTIMAS",
    "HORA",
    "TIPO_DE_CALLE",
    "VICTIMA",
    "ACUSADO",
    "PARTICIPANTES",
)

# Feature columns standardised before clustering places.
SCALED_FEATURES = (
    "business_stars",
    "business_platform",
    "review_stars",
    "review_platform",
    "sentimiento",
    "densidad_restaurantes",
    "distancia_restaurantes_populares",
)

# The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
