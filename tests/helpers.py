"""Fixture rows and comparisons shared by the tests."""

from __future__ import annotations

# Invented fixture rows covering the edge cases of FIXTURES.md.
USERS_TSV = [
    ["#id", "gender", "country", "registered"],
    ["u1", "f", "Spain", "Feb 4, 2005"],
    ["u2", "m", "Congo, the Democratic Republic of the", "Aug 13, 2006"],
    ["u3", "", "Russian Federation", "Aug 04, 2006"],
    ["u4", "f", "United States", "Sept 4, 2005"],
    ["u5", "m", "Korea, Democratic People's Republic of", "junk"],
    ["u6", "f", "", "Feb 30, 2006"],
    ["u7", "m", "Spain", ""],
    ["u8", "f", "France", "AUG 13, 2006"],
    ["u9", "m", "France", "Aug 4 2006"],
    ["u10", "f", "Narnia", "Aug 4, 2006 x"],
    ["u11", "m", "Spain", "Jan 1, 2000"],
    ["u12", "f", "", "Feb 4, 2005"],
]

COUNTRIES_CSV = [
    ["nombre", " name", " nom", " iso2", " iso3", " phone_code", "continente"],
    ["España", "Spain", "Espagne", "ES", "ESP", "34", "Europa"],
    ["Congo", "Congo", "Congo", "CG", "COG", "242", "África"],
    ["Congo", "Congo", "Congo", "CD", "COD", "243", "África"],
    ["Rusia", "Russia", "Russie", "RU", "RUS", "7", "Europa"],
    ["Estados Unidos", "United States of America", "Etats-Unis", "US", "USA", "1", "América"],
    ["Corea del Sur", "South Korea", "Coree du Sud", "KR", "KOR", "82", "Asia"],
    ["Francia", "France", "France", "FR", "FRA", "33", "Europa"],
    ["Isla Heard", "Heard Island", "Ile Heard", "HM", "HMD", "", ""],
    ["Australia", "Australia", "Australie", "AU", "AUS", "61", "Australia y Oceanía"],
]

HOROSCOPES_CSV = [
    ["Date", "Day", "Month", "Horocope"],
    ["Feb 4", "04", "2", "Aquarius"],
    ["Aug 13", "13", "8", "Leo"],
    ["Aug 4", "4", "8", "Leo"],
    ["Sep 4", "4", "9", "Virgo"],
]

FACTS_TSV = [
    ["u1", "2009-05-04T23:08:57Z", "g1", "Underworld", "s1", "Born Slippy"],
    ["u1", "2009-05-04T13:54:10Z", "g1", "Underworld", "s2", '"Rez'],
    ["u2", "not-a-time", "g2", "Deep Dish", "s3", "Flashdance"],
    ["", "2009-05-05T10:00:00Z", "g2", "Deep Dish", "s3", "Flashdance"],
    ["u7", "2009-05-06T10:00:00Z", "g1", "Underworld", "s1", "Born Slippy"],
    ["u99", "2009-05-07T10:00:00Z", "g9", "Underworld", "s9", "Born Slippy"],
    ["u4", "2009-05-08T10:00:00Z", "", "", "s4", ""],
    ["u3", "2009-05-09T10:00:00Z", "g3", "Moby", "s5", "Porcelain"],
]


def rows(df, *cols):
    """Sorted list of tuples (None sorts first)."""
    cols = cols or tuple(df.columns)
    data = [tuple(r[c] for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    return sorted(data, key=lambda t: tuple((x is not None, str(x)) for x in t))
