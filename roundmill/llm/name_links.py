"""Variant spellings of one company, firm or person.

Names are read as a core and a type (``name_parts``); cores of one type that differ by one edit (neighbours
swapped count once) are the same. Pairs are found by the pigeonhole principle: a core that is within two
plain edits of another keeps at least one of its three segments, so the segments of all cores form an
inverted index in which each core looks up its substrings at shifted positions; a banded edit distance
verifies every hit. Short forms of given names, initials and dropped lines of business are linked where
they leave one reading only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundmill.llm.components import components
from roundmill.llm.name_parts import close, parts_of, sound_of
from roundmill.runtime import cut

EDITS = 2  # plain edits that the segments are cut for; a swap of neighbours takes two
LIMIT = 1  # edits accepted, a swap counted once


def segments(core: str) -> list[tuple[int, int, str]]:
    """(number, start, text) of the core's EDITS + 1 segments of nearly equal length."""
    n, k = len(core), EDITS + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(i, cuts[i], core[cuts[i] : cuts[i + 1]]) for i in range(k)]


def index_keys(core: str) -> list[str]:
    return [f"{len(core)}:{i}:{s}" for i, _, s in segments(core)] if len(core) > EDITS else []


def probe_keys(core: str) -> list[str]:
    """Keys under which a core of the same or a smaller length within EDITS edits can stand."""
    out = set()
    for length in range(max(EDITS + 1, len(core) - EDITS), len(core) + 1):
        for i, start, text in segments("x" * length):
            for at in range(max(0, start - EDITS), min(len(core) - len(text), start + EDITS) + 1):
                out.add(f"{length}:{i}:{core[at : at + len(text)]}")
    return list(out)


@F.pandas_udf(T.StructType([T.StructField("core", T.StringType()), T.StructField("type", T.StringType()), T.StructField("sound", T.StringType())]))
def _parts(name: pd.Series) -> pd.DataFrame:
    rows = [(*(p := parts_of(x)), sound_of(p[0])) for x in name]
    return pd.DataFrame(rows, columns=["core", "type", "sound"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _index_keys(core: pd.Series) -> pd.Series:
    return core.map(index_keys)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _probe_keys(core: pd.Series) -> pd.Series:
    return core.map(probe_keys)


@F.pandas_udf(T.IntegerType())
def _edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([close(x, y, LIMIT) for x, y in zip(a, b)], dtype="int32")


def name_entities(names: DataFrame) -> DataFrame:
    """(kind, name, entity) of each distinct non-null name: equal ``entity`` means the same company, firm or person.

    Names without letters or digits have an entity of their own. Blank, repeated and very long names are
    allowed. An empty table gives no row.
    """
    distinct = names.select("kind", "name").where("name is not null").distinct()
    read = cut(distinct.withColumn("p", _parts("name")).select("kind", "name", F.col("p.core").alias("core"), F.col("p.type").alias("type"), F.col("p.sound").alias("sound")))
    key = F.when(F.col("sound") == "", F.concat_ws("|", "kind", F.lit("?"), "name")).otherwise(F.concat_ws("|", "kind", "type", "sound"))
    nodes = read.withColumn("node", key)
    cores = nodes.where("sound <> ''").select("node", "kind", "type", "sound").distinct()
    block = F.when(F.col("type").startswith("initial:"), F.lit("person")).when(F.col("type").startswith("given:"), F.lit("person")).otherwise(F.col("type"))
    cores = cut(cores.withColumn("block", block))
    index = cores.select("block", "kind", F.explode(_index_keys("sound")).alias("key"), F.col("node").alias("b"), F.col("sound").alias("sb"), F.col("type").alias("tb"))
    probe = cores.select("block", "kind", F.explode(_probe_keys("sound")).alias("key"), F.col("node").alias("a"), F.col("sound").alias("sa"), F.col("type").alias("ta"))
    # persons share a block so that initials meet full names; two different given names never match
    initial = F.col("ta").startswith("initial:") != F.col("tb").startswith("initial:")
    letter = lambda t: F.substring(F.substring_index(t, ":", -1), 1, 1)
    fits = (F.col("ta") == F.col("tb")) | (initial & (letter("ta") == letter("tb")))
    hits = probe.join(index, ["block", "kind", "key"]).where((F.col("a") != F.col("b")) & fits).select("a", "b", "sa", "sb", "ta", "tb", "kind").distinct()
    verified = cut(hits.where(_edits("sa", "sb") <= LIMIT))
    same_type = verified.where("ta = tb").select("a", "b")
    groups = components(same_type)
    labelled = cores.join(groups, cores.node == groups.id, "left").select("node", "kind", "type", "sound", F.coalesce("component", "node").alias("group"))

    # an initial joins the one group of full names it fits
    label = lambda c: labelled.select(F.col("node").alias(c), F.col("group").alias(f"g{c}"))
    mixed = verified.where("ta <> tb").join(label("a"), "a").join(label("b"), "b")
    short = F.when(F.col("ta").startswith("initial:"), F.col("ga")).otherwise(F.col("gb"))
    full = F.when(F.col("ta").startswith("initial:"), F.col("gb")).otherwise(F.col("ga"))
    by_initial = mixed.groupBy(short.alias("a")).agg(F.min(full).alias("b"), F.max(full).alias("other")).where("b = other").select("a", "b")
    # a company's name without its line of business joins the one company of that core
    bare = labelled.where("type = ''").select("kind", "sound", F.col("group").alias("a"))
    typed = labelled.where("type <> '' and not type like '%:%'").groupBy("kind", "sound").agg(F.min("group").alias("b"), F.max("group").alias("other")).where("b = other")
    by_core = bare.join(typed, ["kind", "sound"]).select("a", "b").distinct()
    merged = components(by_initial.unionByName(by_core))
    entity = labelled.join(merged, labelled.group == merged.id, "left").select("node", F.coalesce("component", "group").alias("entity"))
    return nodes.join(entity, "node", "left").select("kind", "name", F.coalesce("entity", "node").alias("entity"))


def spelling_pairs(entities: DataFrame) -> DataFrame:
    """(kind, name_a, name_b): every pair of spellings of an entity, name_a before name_b in code point order."""
    a = entities.select("kind", "entity", F.col("name").alias("name_a"))
    b = entities.select("kind", "entity", F.col("name").alias("name_b"))
    return a.join(b, ["kind", "entity"]).where("name_a < name_b").select("kind", "name_a", "name_b")


def typed_names(rounds: DataFrame, investors: DataFrame) -> DataFrame:
    """(kind, name) of both tables, each distinct name once."""
    company = rounds.select(F.lit("company").alias("kind"), F.col("company_name").alias("name"))
    return company.unionByName(investors.select(F.lit("investor").alias("kind"), "name")).where("name is not null").distinct()
