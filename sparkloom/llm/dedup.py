"""Deduplicating new batches against all history.

Method: a persisted index of minwise band keys with the records' words as
signatures, both in buckets by hash. A new batch is tokenised once; its band
keys are shuffled to the buckets of the index and meet only the same bucket
there, candidates are verified on their words, and the batch's keys are
appended. History is never tokenised, signed, grouped or shuffled again.

Words are folded so that layout, case, punctuation, digits and misread
characters do not matter. Where few words are left beside numbers, the numbers
count as words. Two families of bands find candidates: shingles of five words
(whole passages that moved or came in between), and words in their eighth of
the text (edits scattered over all of it, which break most shingles). What
decides is the share of words that are there again in the same order.

Copies of one text in one scope and batch are one entry from the start, so a
group of copies that holds a third of all rows costs one entry. The first
record of a bucket leads it; a new record is compared with the leaders it
meets, at most one for each of its bands. Only where a leader is no match the
bucket's followers are tried, spread over tasks by a salt, so no member is left
out and no task holds a group.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.common import cut, work_path

SHINGLE = 5
#: Bands of five-word shingles, bands of words in their place, rows of either.
SHINGLE_BANDS, PLACE_BANDS, ROWS = 12, 20, 4
BANDS = SHINGLE_BANDS + PLACE_BANDS
#: Parts of a text within which a word keeps its place.
PLACES = 8
#: A record repeats another if so much of either's wording is there again in the same order.
SAME = 0.72
#: Fewest words of a record that is checked, and fewest folded words that are compared without the numbers between them.
MIN_WORDS, MIN_INDEXED = 50, 30
#: Records of fewer folded words than this are compared with their numbers too: one of MIN_INDEXED may repeat one of this many at most.
FEW_WORDS = math.ceil(MIN_INDEXED / SAME)
#: Words of one record whose order is compared at a time; the result does not depend on it.
BLOCK = 8192
#: Records of the first batch that one bucket of the index is made for.
BUCKET_RECORDS = 25_000
#: Parts into which a bucket's followers are spread.
SALTS = 16
#: Batches that are looked up at a time while later ones are appended: each holds plans and broadcast rows in the driver.
LOOKUPS = 1
#: Candidates that hold, of all batches: in a folder by batch, those of the second look beside those of the first.
HELD = "b bigint, a bigint, batch_no int, look int"

_WORD = re.compile(r"[^\W_]+")
_FOLD = str.maketrans({"0": "o", "1": "l", "i": "l", "5": "s", "9": "g", "q": "g", "6": "b", "8": "b", "@": "a", "!": "l"})
_MARKS = re.compile(r"(?<=[^\W\d_])[@!](?=[^\W\d_])")
_BARE = re.compile(r"[^\w\s]+")
#: ASCII letters in lower case and digits; everything else separates words.
_ASCII = bytes(c if chr(c).isalnum() else 32 for c in (ord(chr(b).lower()) for b in range(128))) + b" " * 128


def fold(word: str) -> str | None:
    """The form in which a lower-case word is compared, None for numbers: misread characters are one with the right ones."""
    digits = sum(c.isdigit() for c in word)
    if digits * 2 >= len(word):
        return None
    return word.translate(_FOLD)


def has_words(text: str, least: int = MIN_WORDS) -> bool:
    """True if the text has at least so many blank-separated words that are more than punctuation."""
    words = text.split()
    n = 0
    for i, w in enumerate(words):
        n += w[0].isalnum() or not _BARE.fullmatch(w)
        if n >= least or n + len(words) - i <= least - 1:
            break
    return n >= least


class Signer:
    """Word-hash sequences and the keys of their minwise bands; the permutations are fixed by the seed."""

    def __init__(self, seed: int = 20_240_607):
        rng = np.random.default_rng(seed)
        k = BANDS * ROWS
        self.mul = rng.integers(1, 2**32, k, dtype=np.uint32) | np.uint32(1)
        self.add = rng.integers(0, 2**32, k, dtype=np.uint32)
        self.poly = rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
        self.place = rng.integers(1, 2**63, PLACES, dtype=np.uint64)
        self.seen: dict[str, int] = {}
        self.placed: dict[int, np.ndarray] = {}

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFKC", text)
        elif "@" not in text and "!" not in text:
            return text.encode().translate(_ASCII).decode().split()
        text = text.lower()
        if "@" in text or "!" in text:
            text = _MARKS.sub(lambda m: "a" if m.group(0) == "@" else "l", text)
        return _WORD.findall(text)

    def sequence(self, text: str) -> np.ndarray:
        """32-bit hashes of the text's words, in order; numbers are left out."""
        if len(self.seen) > 500_000:
            self.seen.clear()
        seen, words = self.seen, self._words(text)
        got = [*map(seen.get, words)]
        if None in got:
            for i, h in enumerate(got):
                if h is None:
                    f = fold(words[i])
                    got[i] = seen[words[i]] = -1 if f is None else xxhash.xxh32_intdigest(f)
        out = np.array(got, dtype=np.int64)
        return out[out >= 0].astype(np.uint32)

    def with_numbers(self, text: str) -> np.ndarray:
        """As sequence, with the numbers in their places."""
        return np.array([xxhash.xxh32_intdigest(w.translate(_FOLD)) for w in self._words(text)], dtype=np.uint32)

    def _minima(self, low: np.ndarray, of: slice) -> np.ndarray:
        mul, add = self.mul[of], self.add[of]
        if len(low) <= 1024:
            part = low[:, None] * mul
            part += add
            return part.min(axis=0)
        return np.minimum.reduce([self._minima(low[at : at + 1024], of) for at in range(0, len(low), 1024)])

    def _place(self, n: int) -> np.ndarray:
        """What the place of each of n words adds to its token."""
        if (got := self.placed.get(n)) is None:
            if len(self.placed) > 5000:
                self.placed.clear()
            got = self.placed[n] = self.place[np.arange(n) * PLACES // n]
        return got

    def keys(self, words: np.ndarray, salt: int) -> np.ndarray:
        """One key for each band of one text."""
        return self.all_keys([words], [salt])[0]

    def all_keys(self, texts: list[np.ndarray], salts: list[int]) -> list[np.ndarray]:
        """One key for each band: salt (the scope), band number and the band's minima. Texts: words' hashes of 16 bits or more, at least one; fewer than SHINGLE words have no shingle bands."""
        if not texts:
            return []
        mix = lambda t: ((t ^ t >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
        x = np.concatenate(texts).astype(np.uint64)
        places = mix(x * self.poly[0] + np.concatenate([self._place(len(t)) for t in texts]))
        # Shingles of all texts in one row; those that run from one text into the next are not used.
        shingles, last = np.zeros(max(0, len(x) - SHINGLE + 1), dtype=np.uint64), len(x) - SHINGLE + 1
        for i in range(SHINGLE if last > 0 else 0):
            shingles = shingles * np.uint64(0x9E3779B97F4A7C15) + x[i : last + i] * self.poly[i]
        shingles = mix(shingles)
        minima, at = np.zeros((len(texts), BANDS * ROWS), np.uint64), 0
        for k, t in enumerate(texts):
            end = at + len(t)
            minima[k, SHINGLE_BANDS * ROWS :] = self._minima(places[at:end], slice(SHINGLE_BANDS * ROWS, None))
            if len(t) >= SHINGLE:
                minima[k, : SHINGLE_BANDS * ROWS] = self._minima(shingles[at : end - SHINGLE + 1], slice(0, SHINGLE_BANDS * ROWS))
            at = end
        m = minima.reshape(len(texts), BANDS, ROWS)
        salted = np.array([v & 0xFFFFFFFFFFFFFFFF for v in salts], np.uint64)
        out = salted[:, None] + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(ROWS):
            out = (out ^ m[:, :, r]) * np.uint64(0xFF51AFD7ED558CCD)
            out ^= out >> np.uint64(32)
        own = out.view(np.int64)
        return [own[k] if len(t) >= SHINGLE else own[k, SHINGLE_BANDS:] for k, t in enumerate(texts)]


def common_in_order(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of words, exact at every length.

    What the records begin and end with alike is common. The rest is counted
    bit-parallel in blocks of BLOCK words of a; the carries of a block's
    additions, one a word of b, go into the next block.
    """
    n = min(len(a), len(b))
    head = _alike(a[:n], b[:n])
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    tail = _alike(a[len(a) - n :][::-1], b[len(b) - n :][::-1])
    a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    common, carries = head + tail, bytearray(len(b))
    for start in range(0, len(a), BLOCK):
        part = a[start : start + BLOCK]
        at: dict[int, int] = {}
        for i, w in enumerate(part):
            at[w] = at.get(w, 0) | 1 << i
        size = len(part)
        full = (1 << size) - 1
        v = full
        for j, w in enumerate(b):
            u = v & at.get(w, 0)
            total = v + u + carries[j]
            carries[j] = total >> size
            v = (total | (v - u)) & full
        common += size - v.bit_count()
    return common


def _alike(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two sequences of one length begin with alike."""
    other = a != b
    return int(other.argmax()) if other.any() else len(a)


ENTRY = "doc_id bigint, class_key bigint, class_key2 bigint, scope_key bigint, checked boolean, words binary, batch_no int"


def sign(docs: DataFrame) -> DataFrame:
    """The entry of each record that can repeat or be repeated: its class, its scope's hash, whether it has MIN_WORDS words, its words.

    class_key and class_key2 are one for all copies of a text in a scope.
    Records of fewer than FEW_WORDS folded words are kept with their numbers
    (too, if they have MIN_INDEXED words). Left out are records without text,
    scope, batch or id and those that no record of MIN_WORDS words can repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for b in batches:
            take, checked, hi, lo, salts, words = [], [], [], [], [], []
            scopes = b.column(1).to_pylist()
            for i, t in enumerate(b.column(3).to_pylist()):
                s, numbered = signer.sequence(t), None
                enough = has_words(t)
                if len(s) < FEW_WORDS:
                    numbered = signer.with_numbers(t)
                    if len(s) < MIN_INDEXED:
                        s = s[:0]
                        if len(numbered) < SHINGLE or not enough and len(numbered) < SAME * MIN_WORDS:
                            continue
                take.append(i)
                checked.append(enough)
                exact = s.tobytes() if numbered is None else b"\1" + len(s).to_bytes(2, "little") + s.tobytes() + numbered.tobytes()
                scope = scopes[i].encode()
                digest = xxhash.xxh128_digest(scope + b"\0" + exact)
                hi.append(int.from_bytes(digest[:8], "big", signed=True))
                lo.append(int.from_bytes(digest[8:], "big", signed=True))
                salts.append(xxhash.xxh64_intdigest(scope) - 2**63)
                words.append(_packed(s, numbered))
            idx = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column(0).take(idx), "class_key": pa.array(hi, pa.int64()), "class_key2": pa.array(lo, pa.int64()),
                    "scope_key": pa.array(salts, pa.int64()), "checked": pa.array(checked, pa.bool_()), "words": pa.array(words, pa.binary()), "batch_no": b.column(2).take(idx),
                }
            )

    ready = docs.where("text is not null and scope_id is not null and batch_no is not null and doc_id is not null")
    return ready.select(F.col("doc_id").cast("bigint"), "scope_id", F.col("batch_no").cast("int"), "text").mapInArrow(run, ENTRY)


def _packed(words: np.ndarray, numbered: np.ndarray | None) -> bytes:
    """16-bit hashes of the words; with numbers: a byte (so the length is odd), how many words, the words, the words with numbers."""
    short = lambda x: (x & np.uint32(0xFFFF)).astype(np.uint16).tobytes()
    return short(words) if numbered is None else b"\1" + len(words).to_bytes(2, "little") + short(words) + short(numbered)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words, and the words with numbers; what is not compared is empty."""
    if len(packed) % 2 == 0:
        return np.frombuffer(packed, np.uint16), np.zeros(0, np.uint16)
    end = 3 + 2 * int.from_bytes(packed[1:3], "little")
    return np.frombuffer(packed[3:end], np.uint16), np.frombuffer(packed[end:], np.uint16)


def same_text(a: bytes, b: bytes) -> bool:
    """True if nearly all words of either record are there again in the other, in nearly the same order; where few are words, numbers count as such."""
    return any(_same(x, y) for x, y in zip(_unpacked(a), _unpacked(b), strict=True))


def _same(x: np.ndarray, y: np.ndarray) -> bool:
    most, least = max(len(x), len(y)), min(len(x), len(y))
    return least > 0 and least >= SAME * most and common_in_order(x, y) >= SAME * most


def band(entries: DataFrame) -> DataFrame:
    """(key, doc_id, n): the band keys of entries (doc_id, scope_key, words) with the number of words they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for b in batches:
            salts, of, texts, own = b.column(1).to_pylist(), [], [], []
            for i, packed in enumerate(b.column(2).to_pylist()):
                for numbers, words in enumerate(_unpacked(packed)):
                    if len(words):
                        of.append(i)
                        texts.append(words)
                        own.append(salts[i] + numbers * 0x5851F42D4C957F2D)
            keys = signer.all_keys(texts, own)
            size = [len(k) for k in keys]
            ids = b.column(0).to_numpy(zero_copy_only=False)[np.array(of, np.int64)]
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            lengths = np.repeat(np.array([len(t) for t in texts], np.int32), size) if keys else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_pydict({"key": pa.array(flat, pa.int64()), "doc_id": pa.array(np.repeat(ids, size), pa.int64()), "n": pa.array(lengths, pa.int32())})

    return entries.select("doc_id", "scope_key", "words").mapInArrow(run, "key bigint, doc_id bigint, n int")


def verify(pairs: DataFrame) -> DataFrame:
    """(b, a) of the candidate pairs (b, a, words_b, words_a) that hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3), strict=True)
            keep = [i for i, (x, y) in enumerate(both) if same_text(x.as_py(), y.as_py())]
            idx = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_pydict({"b": batch.column(0).take(idx), "a": batch.column(1).take(idx)})

    return pairs.select("b", "a", "words_b", "words_a").mapInArrow(run, "b bigint, a bigint")


#: How a record stands in a bucket: its first record, a later one, a later one with a smaller id than the bucket's first.
LEADER, FOLLOWER, EARLIER = range(3)
KEYS = "key bigint, doc_id bigint, n int, a bigint, n_a int, batch_no int, standing int"


class HistoryIndex:
    """All records of the batches so far, in a folder: entries in buckets by id, band keys in buckets by key, both partitioned by batch.

    Every record of an earlier batch counts, whether it was accepted or
    repeats another: what repeats it repeats "a document of an earlier batch".
    The records that ``probe`` returns are the batch's repeats; all others are
    accepted. ``buckets`` should be the history's size over what a task can
    hold (by default one for BUCKET_RECORDS records of the first batch, 8 at
    least); it is fixed when the index is made. A batch whose run broke off
    can be run again: it only looks at earlier batches, and repeated rows change nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8):
        self.spark, self.path = spark, path
        name = f"sparkloom_{uuid.uuid4().hex}"
        self.entries_table, self.keys_table = f"{name}_entries", f"{name}_keys"
        for table, schema, by, parts, folder in (
            (self.entries_table, ENTRY, "doc_id", "batch_no", "entries"), (self.keys_table, KEYS, "key", "batch_no, standing", "keys"),
        ):
            spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet PARTITIONED BY ({parts}) CLUSTERED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}/{folder}'")
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
            if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
                spark.catalog.recoverPartitions(table)
        self.buckets = buckets

    def entries(self) -> DataFrame:
        return self.spark.table(self.entries_table)

    def keys(self) -> DataFrame:
        return self.spark.table(self.keys_table)

    def submit(self, docs: DataFrame) -> None:
        """Sign records once and keep their entries, by batch."""
        sign(docs).repartition(self.buckets, "doc_id").write.insertInto(self.entries_table)

    def representatives(self, batch: int) -> DataFrame:
        """One record (doc_id, the smallest) for each text of a scope in a batch."""
        return self.entries().where(F.col("batch_no") == batch).groupBy("class_key", "class_key2").agg(F.min("doc_id").alias("doc_id"))

    def add(self, batch: int) -> None:
        """Look up the band keys of a submitted batch and append them with the leader each met (a, of n_a words; null where it met none)."""
        own = self.entries().where(F.col("batch_no") == batch).join(self.representatives(batch).select("doc_id"), "doc_id", "left_semi")
        fresh = band(own).where("key is not null and n is not null").repartition(self.buckets, "key")
        leaders = self.keys().where((F.col("batch_no") < batch) & (F.col("standing") == LEADER)).select("key", F.col("doc_id").alias("a"), F.col("n").alias("n_a"))
        if any(k < batch for k, _ in self._partitions()):
            # One row a key on the batch's side: that is what is held in memory, never a hot key's many rows nor the history.
            # Both uses of fresh need the same columns, so its exchange is made once.
            firsts = fresh.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("_n"))
            met = firsts.hint("shuffle_hash").join(leaders, "key", "left").select("key", F.when(F.col("_n") >= 0, F.col("first")).alias("first"), "a", "n_a")
            rows = fresh.join(met.hint("shuffle_hash"), "key")
        else:
            rows = fresh.select("*", F.min("doc_id").over(Window.partitionBy("key")).alias("first"), F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("int").alias("n_a"))
        standing = F.when(F.col("a") > F.col("doc_id"), EARLIER).when(F.col("a").isNotNull() | (F.col("first") < F.col("doc_id")), FOLLOWER).otherwise(LEADER)
        rows.select("key", "doc_id", "n", "a", "n_a", F.lit(batch).alias("batch_no"), standing.alias("standing")).write.insertInto(self.keys_table)

    def _partitions(self) -> list[tuple[int, int]]:
        """(batch, standing) of the partitions of band keys."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.keys_table}").collect()
        return [tuple(int(x.partition("=")[2]) for x in r[0].split("/")) for r in rows]

    def probe(self, batch: int) -> DataFrame:
        """(b, a): the smallest id of an earlier batch that each text of a batch repeats, for those that repeat one. b: its representative."""
        path = work_path(self.spark, "dedup-held")
        self.hold(batch, path)
        return self.spark.read.schema(HELD).parquet(path).groupBy("b").agg(F.min("a").alias("a"))

    def hold(self, batch: int, path: str) -> None:
        """Write the candidates of a batch that hold, enough of them for the smallest, to a folder (HELD, partitioned by batch and look)."""
        fits = F.least("n", "n_a") >= SAME * F.greatest("n", "n_a")
        new = self.keys().where((F.col("batch_no") == batch) & F.col("a").isNotNull()).select("key", F.col("doc_id").alias("b"), "n", "a", "n_a")
        tried = cut(new.where(fits).select("b", "a").distinct(), "dedup-tried")
        held = self._held(tried, batch, path, 1)
        # Buckets whose leader is no match: their followers; other buckets: those that came later but have a smaller id.
        # Without followers in the index there is nothing more to try.
        followers = self.keys().where((F.col("batch_no") < batch) & (F.col("standing") != LEADER))
        if not any(k < batch and standing != LEADER for k, standing in self._partitions()):
            return
        below = held.withColumn("below", F.col("a"))
        best = held.groupBy("b").agg(F.min("a").alias("best"))
        open_ = new.join(below, ["b", "a"], "left").join(best, "b", "left").select("key", "b", "n", "below", "best")
        more = cut(self._followers(open_, followers).join(tried, ["b", "a"], "left_anti"), "dedup-more")
        if not more.isEmpty():
            self._held(more, batch, path, 2)

    def _followers(self, open_: DataFrame, followers: DataFrame) -> DataFrame:
        """(b, a), once: open records (key, b, n, below, best) with the followers of their buckets; each bucket's are spread over SALTS tasks."""
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        met = followers.join(open_.select("key").distinct(), "key", "left_semi").select("key", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), (F.col("standing") == EARLIER).alias("earlier"), salt.alias("salt"))
        salted = open_.withColumn("salt", F.explode(F.array([F.lit(k) for k in range(SALTS)])))
        pairs = salted.join(met, ["key", "salt"]).where(F.least("n", "n_a") >= SAME * F.greatest("n", "n_a"))
        return pairs.where("(below is null or earlier and a < below) and (best is null or a < best)").select("b", "a").distinct()

    def _held(self, candidates: DataFrame, batch: int, path: str, look: int) -> DataFrame:
        """The candidates (b, a) that hold, written below a folder of HELD. Only words of candidates leave their buckets; a record with very many candidates is split by adaptive execution."""
        ids = candidates.select(F.col("b").alias("doc_id")).unionByName(candidates.select(F.col("a").alias("doc_id"))).distinct()
        words = cut(self.entries().where(F.col("batch_no") <= batch).select("doc_id", "words").join(ids, "doc_id", "left_semi"), "dedup-words")
        for side in ("b", "a"):
            candidates = candidates.join(words.select(F.col("doc_id").alias(side), F.col("words").alias(f"words_{side}")), side)
        own = f"{path}/batch_no={batch}/look={look}"
        verify(candidates).distinct().write.parquet(own)
        return self.spark.read.schema("b bigint, a bigint").parquet(own)


def dedup_batches(docs: DataFrame, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """(doc_id_a, doc_id_b, batch_no): each record of a later batch with the earliest (smallest doc_id) record of its scope and an earlier batch that it repeats.

    The batches go through one HistoryIndex (at ``path``, else in the shared
    folder) in order: the first is history, every later one is looked up in
    what came before and then appended. Copies inside one batch do not count as
    repeats of each other. Records of fewer than MIN_WORDS words are never
    reported. Repeated rows of one doc_id count once. Null text, scope or
    batch: not compared. No records, no rows.
    """
    spark = docs.sparkSession
    numbers = docs.where("batch_no is not null").groupBy(F.col("batch_no").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy("k").collect()  # one row a batch
    schema = "doc_id_a bigint, doc_id_b bigint, batch_no int"
    if not numbers:
        return spark.createDataFrame([], schema)
    index = HistoryIndex(spark, path or work_path(spark, "dedup-index"), buckets or max(8, math.ceil(numbers[0].n / BUCKET_RECORDS)))
    index.submit(docs)
    if len(numbers) == 1:
        index.add(numbers[0].k)
        return spark.createDataFrame([], schema)
    # A batch is looked up once it is appended; that needs nothing of later batches, which are appended meanwhile.
    # All batches' answers are read from one folder: the plan does not grow with the batches, and the driver keeps none of theirs.
    held = work_path(spark, "dedup-held")
    with ThreadPoolExecutor(LOOKUPS) as pool:
        asked = []
        for i, row in enumerate(numbers):
            index.add(row.k)
            if i:
                asked.append(pool.submit(index.hold, row.k, held))
        for answer in asked:
            answer.result()
    found = spark.read.schema(HELD).parquet(held).groupBy("b", "batch_no").agg(F.min("a").alias("a"))
    # Copies inside a batch are one class: what its representative repeats, all repeat.
    lean = index.entries().select("doc_id", "class_key", "class_key2", "batch_no", "checked")
    classes = ["class_key", "class_key2", "batch_no"]
    of = found.join(lean.select(F.col("doc_id").alias("b"), *classes), ["b", "batch_no"]).groupBy(*classes).agg(F.min("a").alias("a"))
    rows = lean.where("checked").join(of, classes)
    return rows.select(F.col("a").alias("doc_id_a"), F.col("doc_id").alias("doc_id_b"), "batch_no").distinct()
