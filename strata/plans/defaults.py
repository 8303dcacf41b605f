"""Default rules of the listening dataset.

Every job takes these as arguments; the defaults reproduce the published
layers of the original pipeline.
"""

# Continent names as written in the raw countries file
# (Spanish, accents matter) and the English names of the curated layer.
CONTINENT_ES_TO_EN = {
    "Europa": "Europe",
    "África": "Africa",
    "Australia y Oceanía": "Australia and Oceania",
    "América": "America",
    "Antártida": "Antarctica",
}

# Country names of the users file mapped onto the names of
# the countries table; rules are literal prefixes, the first match wins.
# ("Korea, Democratic..." -> "South Korea" and both Congos -> "Congo" are
# the original mapping, kept as published.)
COUNTRY_PREFIX_RULES = (
    ("Congo", "Congo"),
    ("Korea, Democratic", "South Korea"),
    ("Russian", "Russia"),
    ("United States", "United States of America"),
)

# A country missing from the source file, added as
# (pais, country, continente, continent).
ADDED_COUNTRIES = (("Cote D'Ivoire", "Cote D'Ivoire", "África", "Africa"),)

# Stand-ins for a country without a continent.
NO_CONTINENT_ES = "Sin continente"
NO_CONTINENT_EN = "Without continent"

# Header names of the raw countries file that the curated layer drops.
COUNTRY_CODE_COLUMNS = ("iso2", "iso3", "phone_code", "nom")

# Layer table names.
TABLES = ("countries", "horoscopes", "users", "facts")
FACTS_PARTITION_BY = ("user_id",)

# The group and the song that the raw report looks up by name.
AUDITED_GROUP = "Underworld"
AUDITED_SONG = "Elysian Fields"
