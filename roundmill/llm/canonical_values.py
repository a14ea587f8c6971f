"""Mapping freely typed values to a reference list.

Symmetric-delete lookup: every reference phrase and every run of words of a typed value is stored under
all strings got by deleting up to the allowed number of characters; equal keys propose a pair, a weighted
Damerau-Levenshtein distance verifies and ranks it, the more frequent reference breaks ties. Values with
no entry are reported as ``unmatched``. All work is done once per distinct value.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundmill.runtime import broadcast_if_small, cut

MAX_DICTIONARY_ROWS = 500_000  # the delete dictionary is broadcast up to this size and shuffled beyond it
LONG = 12  # phrases from this length on may differ by two edits, shorter ones by one
LONGEST = 40  # phrases beyond this length have segments for keys instead of deletes, whose number grows with the square
SHORT = 4  # phrases below this length must match exactly

# Common short forms of the reference cities that a list of former names lacks.
CITY_ALIASES = {
    "Bengaluru": ["B'lore", "Blore", "Bangaluru"], "Mumbai": ["Bambai"], "New Delhi": ["Dilli", "N Delhi"], "Kolkata": ["Kolkatta"],
    "Hyderabad": ["Cyberabad"], "Varanasi": ["Kashi", "Banaras"], "Puducherry": ["Pondy", "Pondi"], "Kochi": ["Ernakulam"],
    "Prayagraj": ["Prayag"], "Visakhapatnam": ["Waltair", "Vishakhapatnam"], "Tiruchirappalli": ["Tiruchi"], "Thiruvananthapuram": ["Tvpm"],
    "Lucknow": ["Lakhnau"], "Ahmedabad": ["Karnavati"], "Panaji": ["Panjim Goa"], "Gurugram": ["Ggn"],
}
# Airport and station codes; they count only where the typed value is the code, or the code before a comma.
CITY_CODES = {
    "BLR": "Bengaluru", "BOM": "Mumbai", "DEL": "New Delhi", "NDLS": "New Delhi", "GGN": "Gurugram", "HYD": "Hyderabad", "MAA": "Chennai", "PNQ": "Pune",
    "CCU": "Kolkata", "AMD": "Ahmedabad", "JAI": "Jaipur", "COK": "Kochi", "TRV": "Thiruvananthapuram", "TVM": "Thiruvananthapuram", "IDR": "Indore",
    "BHO": "Bhopal", "NAG": "Nagpur", "STV": "Surat", "BDQ": "Vadodara", "LKO": "Lucknow", "KNU": "Kanpur", "IXC": "Chandigarh", "CJB": "Coimbatore",
    "CBE": "Coimbatore", "MYQ": "Mysuru", "IXE": "Mangaluru", "VTZ": "Visakhapatnam", "PNY": "Puducherry", "GAU": "Guwahati", "BBI": "Bhubaneswar",
    "PAT": "Patna", "IXR": "Ranchi", "RPR": "Raipur", "DED": "Dehradun", "GOI": "Panaji", "ISK": "Nashik", "RAJ": "Rajkot", "UDR": "Udaipur",
    "IXD": "Prayagraj", "VNS": "Varanasi", "IXM": "Madurai", "TRZ": "Tiruchirappalli", "CCJ": "Kozhikode", "VGA": "Vijayawada", "SIN": "Singapore",
    "DXB": "Dubai", "LUH": "Ludhiana", "ATQ": "Amritsar", "HBX": "Hubballi", "IXG": "Belagavi",
}
# Towns of their own that lie within an edit or two of a reference city.
OTHER_PLACES = ["Nagaur", "Rajpura", "Raichur", "Nagda", "Puri", "Udupi", "Mathura"]


def words_of(text: str) -> list[str]:
    """Words in plain lower-case letters and digits; apostrophes vanish, all other signs separate."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    return re.sub(r"[^\w]+|_", " ", re.sub(r"['’`]", "", plain)).split()


def runs_of(text: str, longest: int) -> set[str]:
    """Every run of neighbouring words, written without spaces, of up to ``longest`` signs; longer ones fit no phrase."""
    words, out = words_of(text), set()
    for i in range(len(words)):
        run = ""
        for word in words[i:]:
            run += word
            if len(run) > longest:
                break
            out.add(run)
    return out


def allowed_edits(length: int) -> int:
    return 0 if length < SHORT else 1 if length < LONG else 2


def delete_keys(phrase: str) -> set[str]:
    """The phrase without any choice of up to the allowed number of its characters."""
    return {"".join(c for i, c in enumerate(phrase) if i not in gone) for k in range(allowed_edits(len(phrase)) + 1) for gone in combinations(range(len(phrase)), k)}


def _segments(length: int) -> list[tuple[int, int]]:
    """Bounds of the three segments of a long phrase, one of which two edits leave whole."""
    return [(length * i // 3, length * (i + 1) // 3) for i in range(3)]


def phrase_keys(phrase: str) -> set[str]:
    n = len(phrase)
    return delete_keys(phrase) if n <= LONGEST else {f"{n}:{i}:{phrase[a:b]}" for i, (a, b) in enumerate(_segments(n))}


def run_keys(run: str) -> set[str]:
    """Keys under which every phrase within the allowed edits of the run stands: deletes, and beyond LONGEST the run's
    substrings at the places of a phrase's segments, shifted by up to two signs."""
    n = len(run)
    out = delete_keys(run) if n <= LONGEST + 2 else set()
    for length in range(max(LONGEST + 1, n - 2), n + 3):
        out |= {f"{length}:{i}:{run[a + s : b + s]}" for i, (a, b) in enumerate(_segments(length)) for s in range(-2, 3) if a + s >= 0}
    return out


def weighted_distance(a: str, b: str, limit: int) -> float:
    """Damerau-Levenshtein distance (neighbours swapped count once) with weights: a swap 0.7, a letter doubled
    or undoubled 0.5, a vowel for a vowel 0.8, any other edit 1. Above ``limit`` unweighted edits: infinity."""
    if abs(len(a) - len(b)) > limit:
        return float("inf")
    far = (99, 99.0)
    before, row = None, [(j, float(j)) for j in range(len(b) + 1)]
    for j in range(1, len(b) + 1):
        row[j] = (j, row[j - 1][1] + (0.5 if j > 1 and b[j - 1] == b[j - 2] else 1.0))
    for i in range(1, len(a) + 1):
        now = [(i, row[0][1] + (0.5 if i > 1 and a[i - 1] == a[i - 2] else 1.0))] + [far] * len(b)
        for j in range(max(1, i - limit), min(len(b), i + limit) + 1):
            x, y = a[i - 1], b[j - 1]
            change = 0.0 if x == y else 0.8 if x in "aeiouy" and y in "aeiouy" else 1.0
            options = [
                (row[j - 1][0] + (x != y), row[j - 1][1] + change),
                (row[j][0] + 1, row[j][1] + (0.5 if i > 1 and a[i - 2] == x else 1.0)),
                (now[j - 1][0] + 1, now[j - 1][1] + (0.5 if j > 1 and b[j - 2] == y else 1.0)),
            ]
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                options.append((before[j - 2][0] + 1, before[j - 2][1] + 0.7))
            now[j] = min(options)
        before, row = row, now
    return row[-1][1] if row[-1][0] <= limit else float("inf")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _runs(text: pd.Series, longest: pd.Series) -> pd.Series:
    return pd.Series([list(runs_of(t, n)) if t else [] for t, n in zip(text, longest)], dtype=object)


@F.pandas_udf(T.StringType())
def _plain(text: pd.Series) -> pd.Series:
    return text.map(lambda t: "".join(words_of(t or "")))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _phrase_keys(plain: pd.Series) -> pd.Series:
    return plain.map(lambda p: list(phrase_keys(p)) if p else [])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _run_keys(plain: pd.Series) -> pd.Series:
    return plain.map(lambda p: list(run_keys(p)) if p else [])


@F.pandas_udf(T.DoubleType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_distance(x, y, min(allowed_edits(len(x)), allowed_edits(len(y)))) for x, y in zip(a, b)], dtype="float64")


def reference_phrases(sectors: DataFrame, cities: DataFrame) -> DataFrame:
    """(field_name, phrase, ref_key, whole): every name an entry goes by. ``whole`` phrases match only a whole value."""
    spark = cities.sparkSession
    column = lambda *names: F.array_distinct(F.flatten(F.array(*[F.coalesce(n, F.array()) for n in names])))
    one = lambda name: F.array(F.col(name))
    sector = sectors.select(F.lit("sector").alias("field_name"), F.explode(column(one("label"), one("ref_key"), F.col("terms"))).alias("phrase"), "ref_key")
    city = cities.select(F.lit("city").alias("field_name"), F.explode(column(one("ref_key"), F.col("also_known_as"))).alias("phrase"), "ref_key")
    known = cities.select("ref_key").distinct()
    extra = spark.createDataFrame([("city", a, k, False) for k, names in CITY_ALIASES.items() for a in names] + [("city", c, k, True) for c, k in CITY_CODES.items()], "field_name string, phrase string, ref_key string, whole boolean")
    extra = extra.join(broadcast_if_small(known, MAX_DICTIONARY_ROWS), "ref_key", "left_semi")
    other = spark.createDataFrame([("city", p, None, True) for p in OTHER_PLACES], "field_name string, phrase string, ref_key string, whole boolean")
    return sector.unionByName(city).withColumn("whole", F.lit(False)).unionByName(extra).unionByName(other).where("phrase is not null")


def map_values(values: DataFrame, phrases: DataFrame) -> DataFrame:
    """(field_name, value, n) to (field_name, value, n, ref_key, cost): ref_key is ``unmatched`` where no entry fits.

    ``values`` holds each (field_name, value) once with its number of rows. Ties go to the smaller weighted
    distance, then the longer run of words, then the reference written more often, then the smaller ref_key.
    The number of rows of a spelling never decides whether it has an entry; only the listed other places are names of
    their own. Values without letters or digits are unmatched; an empty list leaves all unmatched; an empty table gives
    no row.
    """
    cores = max(values.sparkSession.sparkContext.defaultParallelism, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    named = phrases.select("field_name", "ref_key", "whole", _plain("phrase").alias("phrase")).where("phrase <> ''").distinct()
    dictionary = named.select("*", F.explode(_phrase_keys("phrase")).alias("key"))
    longest = 2 + (named.agg(F.max(F.length("phrase"))).first()[0] or 0)
    typed = values.select("field_name", "value", F.explode(_runs("value", F.lit(longest))).alias("run"))
    # each distinct run is looked up once; runs are few bytes but much work, so they are dealt out whatever their size
    runs = typed.select("field_name", "run").distinct().repartition(cores, "field_name", "run")
    met = runs.select("field_name", "run", F.explode(_run_keys("run")).alias("key")).join(broadcast_if_small(dictionary, MAX_DICTIONARY_ROWS), ["field_name", "key"]).select("field_name", "run", "phrase", "ref_key", "whole").distinct()
    near = met.repartition(cores).withColumn("cost", F.when(F.col("run") == F.col("phrase"), F.lit(0.0)).otherwise(_distance("run", "phrase"))).where("cost < 10")
    pairs = typed.join(cut(near), ["field_name", "run"])
    # how often an entry is written in one of its own names
    weights = values.select("field_name", _plain("value").alias("phrase"), "n").join(named.select("field_name", "phrase", "ref_key").distinct(), ["field_name", "phrase"]).groupBy("field_name", "ref_key").agg(F.sum("n").alias("frequency"))
    head = F.lower(F.regexp_replace(F.split("value", ",")[0], r"[^\p{L}\p{N}]", ""))
    fits = ~F.col("whole") | ((F.col("cost") == 0) & (head == F.col("run")))
    pairs = pairs.where(fits).join(broadcast_if_small(weights, MAX_DICTIONARY_ROWS), ["field_name", "ref_key"], "left")
    rank = F.struct("cost", -F.length("run"), F.when(F.col("ref_key").isNull(), 0).otherwise(1), -F.coalesce("frequency", F.lit(0)), "ref_key")
    best = pairs.groupBy("field_name", "value").agg(F.min_by(F.struct("ref_key", "cost", "run"), rank).alias("b"))
    mapped = values.join(best, ["field_name", "value"], "left").select("field_name", "value", "n", F.col("b.ref_key").alias("ref_key"), F.col("b.cost").alias("cost"))
    return mapped.fillna("unmatched", ["ref_key"])


def stacked(sample: DataFrame) -> DataFrame:
    """(sample_no, field_name, value) of the non-null sector and city of each row."""
    pair = lambda name: F.struct(F.lit(name).alias("field_name"), F.col(name).alias("value"))
    return sample.select("sample_no", F.explode(F.array(pair("sector"), pair("city"))).alias("x")).select("sample_no", "x.field_name", "x.value").where("value is not null")


def canonical_values(sample: DataFrame, sectors: DataFrame, cities: DataFrame) -> DataFrame:
    """(sample_no, field_name, value, ref_key, cost) for each non-null sector and city; ``unmatched`` where none is meant.

    Null values give no row; empty and blank ones are unmatched; repeated rows stay.
    """
    long = stacked(sample)
    mapped = map_values(long.groupBy("field_name", "value").agg(F.count("*").alias("n")), reference_phrases(sectors, cities))
    return long.join(mapped.drop("n"), ["field_name", "value"]).select("sample_no", "field_name", "value", "ref_key", "cost")


def typed_cases(mapped: DataFrame, sectors: DataFrame, cities: DataFrame) -> DataFrame:
    """The rows whose value isn't already exactly an entry's name."""
    exact = sectors.select(F.lit("sector").alias("field_name"), F.col("label").alias("value")).unionByName(cities.select(F.lit("city").alias("field_name"), F.col("ref_key").alias("value"))).where("value is not null").distinct()
    return mapped.join(exact, ["field_name", "value"], "left_anti").select("sample_no", "field_name", "ref_key")
