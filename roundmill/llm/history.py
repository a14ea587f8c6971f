"""New batches checked against everything accepted before, without reading that again.

Every record leaves keys in a persisted index: exact keys (its address, its id) and the keys of the bands of its
minwise signature. Keys are stored by the hash of the key, signatures and other marks by the hash of the id. A batch
reads only the buckets of its own keys and of the records it hits, hits are verified, and then its keys are
added. A repeat is entered under the record that it repeats, so a chain of revisions of any length leads back to
its first page at one look, and under one key every class of pages has one entry: a page revised a million
times costs no pairs.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundmill.functions.urls import canonical_url, page_number
from roundmill.llm.name_parts import close, parts_of, sound_of
from roundmill.operators.units import convert_units
from roundmill.runtime import broadcast_if_small, checkpoint_dir, collect_bounded, cut, stored_rows

BUCKET_RECORDS, MOST_BUCKETS = 2000, 4096  # records of the first batch to a bucket of the index; most buckets
PAGE_BANDS, PAGE_ROWS = 20, 4  # finds a similarity of 0.8 with 0.99997, of 0.65 with 0.975
NAME_BANDS, NAME_ROWS = 12, 2  # of a name's letter pairs: one edit in nine letters is found with 0.98 and more
SIMILAR = 0.6  # of two pages' signatures; a lightly revised page counts, other pages of a site stay below 0.4
SMALL = 500_000  # rows of numbers, no texts, that are broadcast at most; more are joined by a shuffle
REPRESENTED = 0.8  # of a batch, pages as alike as this are entered under one of them
SHINGLE = 5
BODY_WORDS = 9  # lines with fewer words are furniture, not the report
MAX_BATCHES = 10_000  # batches replayed by one call
DAYS, PERCENT = 3, 0.10  # slips of a deal's day and sum

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, 128, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, 128, dtype=np.uint64)
_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def _word_hash(word: str) -> int:
    data = word.encode()
    return (zlib.crc32(data) << 32) | zlib.crc32(data, 0x5BD1E995)


def signature(items: np.ndarray, size: int) -> np.ndarray:
    """Minwise signature (uint32) of a set of 64-bit hashes."""
    mixed = items ^ (items >> np.uint64(29))
    return ((mixed[None, :] * _A[:size, None] + _B[:size, None]) >> np.uint64(32)).min(1).astype(np.uint32)


def page_hashes(text: str, cache: dict[str, int]) -> np.ndarray:
    """Hashes of the five-word shingles of the report's lines; of the whole text if all lines are short."""
    lines = [x.lower().split() for x in text.split("\n")]
    long = [w for w in lines if len(w) >= BODY_WORDS] or [[w for x in lines for w in x]]
    out = []
    for words in long:
        ids = np.empty(max(SHINGLE, len(words)), np.uint64)
        ids[len(words) :] = 0
        for i, w in enumerate(words):
            h = cache.get(w)
            if h is None:
                h = cache[w] = _word_hash(w)
            ids[i] = h
        n = len(ids) - SHINGLE + 1
        mixed = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            mixed = (mixed ^ ids[k : k + n]) * _P[k]
            mixed ^= mixed >> np.uint64(31)
        out.append(mixed)
    return np.unique(np.concatenate(out))


def _band_longs(sig: np.ndarray, bands: int, rows: int) -> list[int]:
    """One signed 64-bit key per band."""
    return [int.from_bytes(hashlib.blake2b(bytes([b]) + sig[b * rows : (b + 1) * rows].tobytes(), digest_size=8).digest(), "little", signed=True) for b in range(bands)]


def _page_signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache: dict[str, int] = {}
    for batch in batches:
        if len(cache) > 500_000:
            cache.clear()
        bands, sigs = [], []
        for text in batch["text"]:
            if text and not text.isspace():
                sig = signature(page_hashes(text, cache), PAGE_BANDS * PAGE_ROWS)
                bands.append(_band_longs(sig, PAGE_BANDS, PAGE_ROWS))
                sigs.append(sig.tobytes())
            else:
                bands.append([])
                sigs.append(None)
        yield pd.DataFrame({"id": batch["fetch_id"], "batch_no": batch["batch_no"], "url": batch["url"], "title": batch["title"], "bands": bands, "sig": sigs})


#: What is kept of a record: its exact keys, its band keys, and what verifies a hit.
RECORD = "id long, batch_no int, exact array<bigint>, bands array<bigint>, sig binary, core string, type string, day int, usd double, raw string, recorded double, letters long"
KEY = "key bigint, exact boolean, id long, first_batch int, first_id long, letters long, bucket int"
MARKS = ["sig", "core", "type", "day", "usd", "raw", "recorded"]


def _records(df: DataFrame, **columns) -> DataFrame:  # noqa: ANN003
    names = [c.split(" ") for c in RECORD.split(", ")]
    return df.select(*[columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in names])


def page_records(articles: DataFrame) -> DataFrame:
    """Pages as records. Exact keys are the address in one form, and the page's number on its site with its title."""
    read = articles.select("fetch_id", "batch_no", "url", "title", "text").where("fetch_id is not null and batch_no is not null")
    sig = read.mapInPandas(_page_signatures, "id long, batch_no int, url string, title string, bands array<bigint>, sig binary")
    address = canonical_url(F.col("url"))
    number = F.when(page_number(address).isNotNull() & F.col("title").isNotNull(), F.xxhash64(F.lit("n"), page_number(address), F.lower("title")))
    exact = F.filter(F.array(F.when(address.isNotNull(), F.xxhash64(F.lit("u"), address)), number), lambda k: k.isNotNull())
    return _records(sig, id=F.col("id"), batch_no=F.col("batch_no"), exact=exact, bands=F.col("bands"), sig=F.col("sig"))


def _letters(text: str) -> int:
    """64 bits: the first two occurrences of each of 32 classes of letters. One edit changes two at most."""
    bits = 0
    for c in text:
        at = 2 * (ord(c) % 32)
        bits |= 1 << at + (bits >> at & 1)
    return bits - (bits >> 63 << 64)


def _name_bands(name: str) -> tuple[str, str, list[int], int]:
    core, kind = parts_of(name)
    sound = sound_of(core)
    padded = f"^{sound}$"
    hashes = np.array([_word_hash(padded[i : i + 2]) for i in range(len(padded) - 1)], np.uint64)
    return sound, kind, _band_longs(signature(np.unique(hashes), NAME_BANDS * NAME_ROWS), NAME_BANDS, NAME_ROWS), _letters(sound)


@F.pandas_udf(T.StructType([T.StructField("core", T.StringType()), T.StructField("type", T.StringType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("letters", T.LongType())]))
def _name_signature(name: pd.Series) -> pd.DataFrame:
    rows = [_name_bands(x) if x else (None, None, [], 0) for x in name]
    return pd.DataFrame(rows, columns=["core", "type", "bands", "letters"])


def round_records(rounds: DataFrame, rates: DataFrame) -> DataFrame:
    """Deals as records. The exact key is the deal's id; the bands are those of the letter pairs of its company's name,
    made once per distinct name."""
    usd = convert_units(rounds, rates).select("record_id", "usd").dropDuplicates(["record_id"])
    raw = F.when(F.col("amount").isNotNull(), F.concat_ws(" ", F.col("amount").cast("string"), F.coalesce(F.upper("currency"), F.lit(""))))
    base = rounds.where("record_id is not null and batch_no is not null").select("record_id", "batch_no", "round_id", "company_name", F.unix_date("announced_on").alias("day"), raw.alias("raw"), F.when(F.col("amount_usd") > 0, F.col("amount_usd")).alias("recorded"))
    names = base.select("company_name").where("company_name is not null").distinct().withColumn("p", _name_signature("company_name"))
    full = base.join(usd, "record_id", "left").join(names, "company_name", "left")
    exact = F.when(F.col("round_id").isNotNull(), F.array(F.xxhash64(F.lit("i"), "round_id"))).otherwise(F.array())
    some = {n: F.col(n) for n in ("batch_no", "day", "usd", "raw", "recorded")}
    return _records(full, id=F.col("record_id"), exact=exact, bands=F.coalesce("p.bands", F.array().cast("array<bigint>")), core=F.col("p.core"), type=F.col("p.type"), letters=F.col("p.letters"), **some)


def _deal_keys() -> tuple[Column, Column]:
    """(kept, asked) keys of a deal's bands: with its day, four days to a bucket, and with the size of its sum for pairs in which
    a day is missing. The three buckets around its own are asked for."""
    has_day, has_sum = F.col("day").isNotNull(), F.col("usd") > 0
    week, size = F.floor(F.col("day") / (DAYS + 1)), F.floor(F.ln("usd") / 0.11)
    none = F.array().cast("array<bigint>")
    near = lambda mark, at: F.array(*[F.struct(F.lit(mark).alias("m"), (at + s).alias("at")) for s in (-1, 0, 1)])
    one = lambda mark, at: F.array(F.struct(F.lit(mark).alias("m"), at.alias("at")))
    slots = F.array().cast("array<struct<m:string,at:bigint>>")
    kept = F.concat(F.when(has_day, one("d", week)).otherwise(slots), F.when(has_sum & has_day, one("A", size)).when(has_sum, one("a", size)).otherwise(slots))
    asked = F.concat(F.when(has_day, near("d", week)).otherwise(slots), F.when(has_sum, near("a", size)).otherwise(slots), F.when(has_sum & ~has_day, near("A", size)).otherwise(slots))
    cross = lambda part: F.coalesce(F.flatten(F.transform("bands", lambda b: F.transform(part, lambda s: F.xxhash64(b, s["m"], s["at"])))), none)
    return cross(kept), cross(asked)


@F.pandas_udf(T.DoubleType())
def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([0.0 if x is None or y is None else float((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).mean()) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.IntegerType())
def _name_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([9 if x is None or y is None else close(x, y, 1) for x, y in zip(a, b)], dtype="int32")


class History:
    """The persisted index of one kind of record, in a folder all executors share. The number of buckets is set by the size
    of the first batch."""

    def __init__(self, spark: SparkSession, kind: str, path: str | None = None) -> None:
        self.spark, self.kind = spark, kind
        self.path = path or f"{checkpoint_dir(spark)}/history-{kind}-{uuid.uuid4().hex}"
        self.parts, self.buckets = 0, 0
        self.hints = ["letters"] if kind == "round" else []  # kept with a key; they rule a hit out before its marks are fetched

    def _bucket(self, c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def _keys(self, records: DataFrame, asked: bool) -> DataFrame:
        own = F.col("bands") if self.kind == "article" else _deal_keys()[asked]
        tagged = F.concat(F.transform("exact", lambda k: F.struct(k.alias("key"), F.lit(True).alias("exact"))), F.transform(own, lambda k: F.struct(k.alias("key"), F.lit(False).alias("exact"))))
        first = ["first"] if "first" in records.columns else []
        rows = records.select("id", *first, *self.hints, F.xxhash64(*MARKS).alias("content"), F.explode(tagged).alias("k"))
        return rows.select("id", *first, *self.hints, "content", "k.key", "k.exact", self._bucket(F.col("k.key")).alias("bucket"))

    def _asked(self, df: DataFrame, name: str, what: str) -> dict[int, int]:
        """The buckets in which rows are asked for, and how many are in each; there are no more than MOST_BUCKETS."""
        return {r[0]: r[1] for r in collect_bounded(df.groupBy(name).agg(F.count("*")), MOST_BUCKETS, what)}

    def _likely(self, both: DataFrame, least: float = SIMILAR) -> DataFrame:
        """Of pairs with their marks p and q those that are alike."""
        return both.where(_likeness("p.sig", "q.sig") >= least) if self.kind == "article" else both.where(self._deals()).where(_name_edits("p.core", "q.core") <= 1)

    def _classed(self, records: DataFrame) -> DataFrame:
        """A page all but equal to the earliest one under a key of its own batch is of its class."""
        fresh = self._keys(records, False).where("not exact")
        lead = cut(fresh.groupBy("key").agg(F.min(F.struct("first", "id")).alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n"))
        if not (n := stored_rows(lead)):
            return records
        pairs = fresh.join(broadcast_if_small(lead, SMALL, n), "key").where("first <> lead.first").select("id", F.col("lead.id").alias("other"), F.col("lead.first").alias("lead_first")).distinct()
        marks = lambda name, column: records.select(F.col("id").alias(column), F.struct(*MARKS).alias(name)).dropDuplicates([column])
        near = self._likely(pairs.join(marks("p", "id"), "id").join(marks("q", "other"), "other"), REPRESENTED)
        near = cut(near.groupBy("id").agg(F.min("lead_first").alias("lead_first")))
        if not (n := stored_rows(near)):
            return records
        return records.join(broadcast_if_small(near, SMALL, n), "id", "left").withColumn("first", F.coalesce(F.least("first", "lead_first"), "first")).drop("lead_first")

    def append(self, records: DataFrame, found: DataFrame | None = None) -> None:
        """Add a batch. ``found`` (first_batch, first_id, second_id) are the repeats among it: they are entered under the
        record they repeat. Of records with one key, one content and one first record only the earliest is entered; so
        are, under one key, pages that are all but equal to the earliest page of the batch there."""
        if not self.buckets:
            wanted = max(8, records.count() // BUCKET_RECORDS)
            self.buckets = min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())
        records.select("id", *MARKS).withColumn("bucket", self._bucket(F.col("id"))).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/records")
        own = F.struct("batch_no", "id")
        if found is not None and (n := stored_rows(found)):
            under = broadcast_if_small(found.select(F.col("second_id").alias("id"), F.struct(F.col("first_batch").alias("batch_no"), F.col("first_id").alias("id")).alias("under")), SMALL, n)
            own, records = F.coalesce("under", own), records.join(under, "id", "left")
        records = records.withColumn("first", own)
        if self.kind == "article":
            records = self._classed(records)
            content = F.lit(0).cast("bigint")
        else:
            content = F.when(F.col("exact"), F.lit(0).cast("bigint")).otherwise(F.col("content"))
        # rows of one class under one key are taken together before they are dealt out by bucket
        entered = self._keys(records, False).groupBy("bucket", "key", "exact", content.alias("content"), "first").agg(F.min("id").alias("id"), *[F.min(h).alias(h) for h in self.hints])
        entered = entered.select("key", "exact", "id", F.col("first.batch_no").alias("first_batch"), F.col("first.id").alias("first_id"), *self.hints, "bucket")
        entered.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/keys")
        self.parts += 1

    def probe(self, records: DataFrame) -> DataFrame:
        """(first_id, second_id) of the records that repeat one of those added before; the earliest such one counts."""
        return self._found(records).select("first_id", "second_id")

    def _found(self, records: DataFrame) -> DataFrame:
        """(first_id, second_id, first_batch) of the records that repeat one of those added before; the earliest such one counts."""
        if not self.parts:
            return self.spark.createDataFrame([], "first_id long, second_id long, first_batch int")
        asked = self._keys(records, True).select("bucket", "key", F.col("id").alias("second_id"), *[F.col(h).alias(f"asked_{h}") for h in self.hints])
        buckets = self._asked(asked, "bucket", "buckets of keys")
        stored = self.spark.read.schema(KEY).parquet(f"{self.path}/keys").where(F.col("bucket").isin(*buckets))
        # the key alone tells the bucket; joined by the bucket too, each plan would prune once more by a query of its own
        hits = stored.join(broadcast_if_small(asked.drop("bucket"), SMALL, sum(buckets.values())), "key").where("id <> second_id")
        if self.hints:  # names of two letters' difference and more share keys by chance, more so the more deals there are
            hits = hits.where("exact or bit_count(letters ^ asked_letters) <= 2")
        pairs = hits.groupBy("id", "second_id").agg(F.max("exact").alias("exact"), F.min(F.struct("first_batch", "first_id")).alias("first"))
        pairs = cut(pairs.withColumn("bucket", self._bucket(F.col("id"))))
        known = self.spark.read.schema("id long, sig binary, core string, type string, day int, usd double, raw string, recorded double, bucket int").parquet(f"{self.path}/records")
        loose = pairs.where("not exact")
        buckets = self._asked(loose, "bucket", "buckets of records")
        known = known.where(F.col("bucket").isin(*buckets)).select("id", F.struct(*MARKS).alias("p"))
        both = known.join(broadcast_if_small(loose.drop("bucket"), SMALL, sum(buckets.values())), "id").dropDuplicates(["id", "second_id"]).join(records.select(F.col("id").alias("second_id"), F.struct(*MARKS).alias("q")), "second_id")
        alike = pairs.where("exact").select("first", "second_id").unionByName(self._likely(both).select("first", "second_id"))
        return alike.groupBy("second_id").agg(F.min("first").alias("m")).select(F.col("m.first_id").alias("first_id"), "second_id", F.col("m.first_batch").alias("first_batch"))

    def add(self, records: DataFrame) -> DataFrame:
        """Probe a batch, then append it; gives its repeats."""
        found = cut(self._found(records))
        self.append(records, found)
        return found

    def drop(self) -> None:
        """Delete the stored index."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    @staticmethod
    def _deals() -> Column:
        p, q = (lambda c: F.col(f"p.{c}")), (lambda c: F.col(f"q.{c}"))
        no_day = p("day").isNull() | q("day").isNull()
        no_sum = p("usd").isNull() | q("usd").isNull()
        near = lambda c: F.coalesce(F.abs(p(c) - q(c)) <= PERCENT * F.greatest(p(c), q(c)), F.lit(False))
        same_raw = F.coalesce(p("raw") == q("raw"), F.lit(False))
        near_day = F.coalesce(F.abs(p("day") - q("day")) <= DAYS, F.lit(False))
        fits = (near_day & (no_sum | near("usd") | same_raw | near("recorded"))) | (no_day & near("usd"))
        kind = (p("type") == q("type")) | ((p("core") == q("core")) & ((p("type") == "") | (q("type") == "")))
        return fits & kind


def first_of_all(pairs: DataFrame) -> DataFrame:
    """Where the earlier record is itself a repeat, take the record that it repeats, until none is."""
    pairs = cut(pairs.select("first_id", "second_id"))
    while True:
        up = pairs.select(F.col("second_id").alias("first_id"), F.col("first_id").alias("older"))
        moved = cut(pairs.join(up, "first_id", "left").select(F.coalesce("older", "first_id").alias("first_id"), "second_id", F.col("older").isNotNull().alias("moved")))
        pairs = moved.drop("moved")
        if moved.where("moved").limit(1).count() == 0:
            return pairs


def repeats(records: DataFrame, kind: str) -> DataFrame:
    """(kind, first_id, second_id) of all records of batch 1 and later that repeat one of an earlier batch.

    Batch after batch is probed and then added to an index that starts empty and is deleted at the end. Records without id
    or batch are left out; an empty table gives no row.
    """
    spark = records.sparkSession
    history = History(spark, kind)
    records.write.partitionBy("batch_no").parquet(f"{history.path}/read")
    stored = spark.read.schema(RECORD).parquet(f"{history.path}/read")
    batches = sorted(r[0] for r in collect_bounded(stored.select("batch_no").distinct(), MAX_BATCHES, "batches"))
    out = spark.createDataFrame([], "first_id long, second_id long")
    for batch in batches:
        now = stored.where(F.col("batch_no") == batch)
        found = history.add(now) if batch != batches[-1] else cut(history.probe(now))
        if batch > 0:
            out = out.unionByName(found.select("first_id", "second_id"))
    history.drop()
    return out.select(F.lit(kind).alias("kind"), "first_id", "second_id")


def repeated_records(articles: DataFrame, rounds: DataFrame, rates: DataFrame) -> DataFrame:
    """Repeated pages and deals together."""
    return repeats(page_records(articles), "article").unionByName(repeats(round_records(rounds, rates), "round"))
