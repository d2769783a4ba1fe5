"""Phrase collocation mining: frequent n-grams by mergeable Misra-Gries summaries, an exact second pass, and scores by the best cut.

First pass. An n-gram of a language is a 64-bit key whose leading bits name a hash partition. Tasks count keys of bounded parts of the text and
write one small summary for each partition. All summaries of a partition are merged with more counters than its mass divided by the
threshold: when a merge has too many, the largest count that is one too many is taken from all. What that takes from a key over all
merges stays below the threshold, so every frequent n-gram keeps a counter, whatever the order of merges. Masses count a key at most
``threshold`` times in a summary, more can't change whether it is frequent.

Second pass. N-grams whose key may have survived (a Bloom filter of fixed size; a false hit costs time only) are counted as phrases, word by
word, so equal keys of different phrases don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import text_batches

LONGEST = 4
THRESHOLD = 30
# A candidate is dropped for a longer one with at least this share of its count, as numerator and denominator.
COVERED = (80, 100)
SCALE = 2_000_000
FIRST = 2000
# Words whose n-grams are counted together in a task, and bytes of a long text that are split at a time.
WINDOW, SLICE = 1 << 20, 1 << 20
# Counters of a hash partition at most, as far as partitions suffice; partitions at least and at most.
COUNTERS, PARTITIONS = 1 << 20, (64, 1 << 16)
# Bits of the Bloom filter (8 MB, whatever the input) and bits of each key.
BITS, HASHES = 1 << 26, 3
# Words that a task remembers between windows, and their bytes.
WORDS, WORD_BYTES = 300_000, 1 << 24
_BREAK = b"\n"
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b for b in range(256))


def read(docs: DataFrame) -> DataFrame:
    """``lang, text`` with nulls as ``und`` and the empty text."""
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


class Words(dict):
    """Numbers of words from 1 on, in the order they are met; 0 is the break between pieces."""

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self[_BREAK] = 0
        self.names, self.keys_, self.bytes = [_BREAK], [0], 0

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        self[word] = number = len(self.names)
        self.names.append(word)
        self.keys_.append(xxh64_intdigest(word, 42))
        self.bytes += len(word)
        return number


def numbers(text: str, words: Words):
    """The word numbers of a text with a 0 wherever a piece ends, and at the end."""
    import numpy as np

    data, start, parts = text.encode().translate(_PLAIN), 0, []
    while start < len(data):
        end = data.find(b" ", start + SLICE) if len(data) - start > SLICE else -1
        end = len(data) if end < 0 else end
        found = [w for w in data[start:end].replace(_BREAK, b" \n ").split(b" ") if w]
        parts.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
        start = end
    return np.concatenate([*parts, np.zeros(1, np.int32)])


def windows(batches, words: Words, window: int = WINDOW, remembered: int = WORDS) -> Iterator[tuple[str, object]]:
    """``lang, numbers`` of bounded parts of the texts; three words of the next part stand behind each, behind a text there are breaks.

    N-grams that begin in the first ``len - 3`` places belong to the part.
    """
    import numpy as np

    tail = np.zeros(LONGEST - 1, np.int32)
    held: dict[str, list] = {}
    size = 0

    def hand_on() -> Iterator:
        for lang, parts in held.items():
            joined = np.concatenate([*parts, tail])
            for i in range(0, len(joined) - len(tail), window):
                yield lang, joined[i : i + window + len(tail)]
        held.clear()

    for whole in batches:
        for batch in text_batches(whole):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = numbers(text, words)
                held.setdefault(lang, []).append(found)
                size += len(found)
                if size >= window:
                    yield from hand_on()
                    size = 0
                    if len(words) > remembered or words.bytes > WORD_BYTES:
                        words.forget()
    yield from hand_on()


def gram_keys(found, keys, seed: int) -> Iterator:
    """For 1 to ``LONGEST`` words: 64-bit keys of the n-grams of a window, and the places where they begin."""
    import numpy as np

    n = len(found) - LONGEST + 1
    live, made = np.ones(n, bool), np.full(n, seed, np.uint64)
    for k in range(LONGEST):
        word = found[k : k + n]
        live = live & (word > 0)
        made = (made ^ keys[word]) * np.uint64(0x9E3779B97F4A7C15)
        made ^= made >> np.uint64(29)
        made *= np.uint64(0xBF58476D1CE4E5B9)
        made ^= made >> np.uint64(32)
        at = np.flatnonzero(live)
        yield k + 1, made[at], at


def _seed(lang: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(lang, 7)


def packed(prints, counts) -> bytes:
    """Sorted 32-bit prints as differences, and their counts, compressed."""
    import numpy as np
    import pyarrow as pa

    steps = np.diff(prints, prepend=np.uint32(0)).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()  # equal bytes together: the high ones are mostly 0
    raw = planes + counts.astype(np.uint8).tobytes()
    return len(prints).to_bytes(4, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpacked(blob: bytes):
    """``prints, counts`` of a packed summary."""
    import numpy as np
    import pyarrow as pa

    n = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob[4:], 5 * n, asbytes=True), np.uint8)
    steps = np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32), raw[4 * n :].astype(np.int64)


def summaries(rows: DataFrame, partitions: int, threshold: int, **sizes: int) -> DataFrame:
    """``part, mass, summary``: counts of the keys of each hash partition, over bounded parts of the text."""
    shift = 64 - (partitions.bit_length() - 1)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        words = Words()
        edges = np.arange(1, partitions, dtype=np.uint64) << np.uint64(shift)
        for lang, found in windows(batches, words, **sizes):
            table = np.array(words.keys_, np.uint64)
            keys, counts = np.unique(np.concatenate([k for _, k, _ in gram_keys(found, table, _seed(lang))]), return_counts=True)
            counts = np.minimum(counts, threshold)
            prints = ((keys << np.uint64(64 - shift)) >> np.uint64(32)).astype(np.uint32)
            cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
            made: list[tuple[int, int, bytes]] = []
            for part in np.flatnonzero(np.diff(cuts)).tolist():
                own, n = prints[cuts[part] : cuts[part + 1]], counts[cuts[part] : cuts[part + 1]]
                if (own[1:] == own[:-1]).any():  # keys that agree in all bits that count
                    own, back = np.unique(own, return_inverse=True)
                    n = np.minimum(np.bincount(back, n).astype(np.int64), threshold)
                made.append((part, int(n.sum()), packed(own, n)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made) if made else ((), (), ()), (pa.int32(), pa.int64(), pa.binary()))], names=["part", "mass", "summary"]
            )

    return rows.mapInArrow(run, "part int, mass long, summary binary")


class Summary:
    """A Misra-Gries summary over packed ones: ``counters`` counters, and how much was taken from every key at most."""

    def __init__(self, counters: int):
        import numpy as np

        self.counters, self.taken = counters, 0
        self.prints, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list = []
        self.size = 0

    def add(self, blob: bytes) -> None:
        self.waiting.append(unpacked(blob))
        self.size += len(self.waiting[-1][0])
        if self.size > self.counters:
            self.merge()

    def merge(self) -> None:
        import numpy as np

        prints = np.concatenate([self.prints, *(p for p, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.size = [], 0
        self.prints, back = np.unique(prints, return_inverse=True)
        self.counts = np.bincount(back, counts, len(self.prints)).astype(np.int64)
        if len(self.counts) > self.counters:
            over = int(np.partition(self.counts, -self.counters - 1)[-self.counters - 1])
            self.taken += over
            keep = self.counts > over
            self.prints, self.counts = self.prints[keep], self.counts[keep] - over

    def frequent(self, threshold: int):
        """The prints that may have reached the threshold; no other has."""
        self.merge()
        return self.prints[self.counts + self.taken >= threshold]


def survivors(rows: DataFrame, scratch: Scratch, threshold: int = THRESHOLD, counters: int = COUNTERS, partitions: tuple[int, int] = PARTITIONS, **sizes: int) -> tuple[DataFrame, int]:
    """``part, print`` of all keys that may be frequent, and the number of hash partitions."""
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    least, most = partitions
    # Words are at least two characters with their separator, so this is more than there are n-grams.
    parts = min(most, 1 << max(least.bit_length() - 1, (LONGEST * letters // 2 // (threshold * counters)).bit_length()))
    written = scratch.save(summaries(rows, parts, threshold, **sizes), "summaries")
    # One number for each partition, at most 65,536.
    mass = {r.part: r.mass for r in written.groupBy("part").agg(F.sum("mass").alias("mass")).collect()}

    def run(batches) -> Iterator:
        import pyarrow as pa

        at, summary = None, None

        def found():
            prints = summary.frequent(threshold)
            return pa.RecordBatch.from_arrays([pa.array([at] * len(prints), pa.int32()), pa.array(prints.astype("int64"))], names=["part", "print"])

        for batch in batches:
            for part, blob in zip(batch.column(0), batch.column(1)):
                if part.as_py() != at:
                    if summary is not None:
                        yield found()
                    at = part.as_py()
                    summary = Summary(mass[at] // threshold + 1)
                summary.add(blob.as_py())
        if summary is not None:
            yield found()

    dealt = written.select("part", "summary").repartition("part").sortWithinPartitions("part")
    return scratch.save(dealt.mapInArrow(run, "part int, print long"), "survivors"), parts


def filter_places(keys, shift: int, bits: int = BITS, hashes: int = HASHES) -> Iterator:
    """The places of keys in the filter, by their leading bits that summaries tell apart."""
    import numpy as np

    lead = keys >> np.uint64(shift - 32)
    for k in range(hashes):
        mixed = (lead + np.uint64(k)) * np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[k % 3])
        yield (mixed ^ (mixed >> np.uint64(31))) % np.uint64(bits)


def bloom(found: DataFrame, partitions: int, bits: int = BITS) -> bytes:
    """The filter over ``part, print``, built by Spark and handed to the driver in blocks of 4 KB."""
    shift = 64 - (partitions.bit_length() - 1)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            part, prints = (batch.column(i).to_numpy().astype(np.uint64) for i in (0, 1))
            keys = (part << np.uint64(shift)) | (prints << np.uint64(shift - 32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(filter_places(keys, shift, bits))).astype(np.int64))], names=["bit"])

    blocks = found.mapInArrow(run, "bit long").groupBy(F.shiftright("bit", 15).alias("block"))
    made = bytearray(bits // 8)
    for r in blocks.agg(F.bitmap_construct_agg(F.col("bit") % (1 << 15)).alias("bits")).collect():
        made[r.block << 12 : (r.block + 1) << 12] = r.bits
    return bytes(made)


def phrase_counts(rows: DataFrame, found: DataFrame, partitions: int, bits: int = BITS, **sizes: int) -> DataFrame:
    """``lang, phrase, words, n`` of n-grams that pass the filter, and of all words together (0 words); a key comes several times."""
    shift = 64 - (partitions.bit_length() - 1)
    shared = rows.sparkSession.sparkContext.broadcast(bloom(found, partitions, bits))

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        words = Words()
        known = np.frombuffer(shared.value, np.uint8)
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        for lang, found in windows(batches, words, **sizes):
            table = np.array(words.keys_, np.uint64)
            made: list[tuple[str, str, int, int]] = [(lang, "", 0, int((found[: 1 - LONGEST] > 0).sum()))]
            for n, keys, at in gram_keys(found, table, _seed(lang)):
                live = np.ones(len(keys), bool)
                for place in filter_places(keys, shift, bits):
                    live &= (known[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                at = at[live]
                # Equal phrases get equal numbers, word by word.
                same = found[at].astype(np.int64)
                for k in range(1, n):
                    _, same = np.unique(same * len(table) + found[at + k], return_inverse=True)
                _, first, counts = np.unique(same, return_index=True, return_counts=True)
                for i, c in zip(at[first].tolist(), counts.tolist()):
                    phrase = b" ".join([words.names[w] for w in found[i : i + n].tolist()])
                    made.append((lang, phrase.decode(), n, c))
            for i in range(0, len(made), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made[i : i + 50_000]), kinds)], names=["lang", "phrase", "words", "n"])

    return rows.mapInArrow(run, "lang string, phrase string, words int, n long")


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def scored(frequent: DataFrame, scratch: Scratch) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of phrases of two and more words, by the cut with the lowest score, then the first.

    ``frequent`` has ``lang, phrase, words, a`` of all n-grams of any length that reach the threshold.
    """
    pairs = frequent.where("words > 1").select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    split = F.split("phrase", " ")
    cuts = pairs.select("*", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice(split, F.col("k") + 1, F.col("words")), " ").alias("rest"))
    cuts = scratch.save(cuts, "cuts")
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    rests = frequent.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    joined = scratch.save(cuts.join(heads, ["lang", "head"]), "heads").join(rests, ["lang", "rest"])
    score = F.call_function("div", _wide(F.col("a")) * F.lit(SCALE).cast("decimal(10,0)"), _wide(F.col("l")) + _wide(F.col("r")))
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least")
    return joined.groupBy("lang", "phrase", "words", "a").agg(least).select("lang", "phrase", "words", "a", "least.l", "least.r", "least.score")


def collocations(
    docs: DataFrame, scratch: Scratch, threshold: int = THRESHOLD, covered: tuple[int, int] = COVERED, first: int | None = FIRST, counters: int = COUNTERS, bits: int = BITS, **sizes: int
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` phrases of each language by score, count and phrase; None for all.

    Null texts count as empty, null languages as ``und``; repeated rows count again, ids aren't looked at. Languages without a candidate
    and empty tables give no rows; other columns are ignored.
    """
    rows = read(docs)
    found, parts = survivors(rows, scratch, threshold, counters, **sizes)
    counted = phrase_counts(rows, found, parts, bits, **sizes).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("a"))
    counted = scratch.save(counted.where((F.col("a") >= threshold) | (F.col("words") == 0)), "counted")
    totals = counted.where("words = 0").select("lang", F.col("a").alias("n"))
    frequent = counted.where("words > 0")
    candidates = scratch.save(scored(frequent, scratch), "scored")
    split = F.split("phrase", " ")
    starts = lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice(split, i, F.lit(n)), " "))
    inner = F.array(*[F.when(F.col("words") > n, starts(n)).otherwise(F.array().cast("array<string>")) for n in range(2, LONGEST)])
    longer = candidates.where("words > 2").select("lang", "a", F.explode(F.flatten(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    share, whole = (F.lit(c).cast("decimal(10,0)") for c in covered)
    hidden = _wide(F.col("longer")) * whole >= _wide(F.col("a")) * share
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~hidden)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    best = kept.withColumn("rank", rank)
    best = best if first is None else best.where(F.col("rank") <= first)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM t),
s AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
o AS (SELECT lang, len, array_to_string(words[i : i + len - 1], ' ') AS phrase FROM s, (SELECT unnest([1, 2, 3, 4]) AS len) WHERE i + len - 1 <= len(words)),
n AS (SELECT lang, count(*) AS n FROM o WHERE len = 1 GROUP BY lang),
f AS (SELECT lang, len, phrase, count(*) AS a FROM o GROUP BY ALL HAVING count(*) >= {THRESHOLD}),
k AS (SELECT *, string_split(phrase, ' ') AS p, unnest(range(1, len)) AS k FROM f WHERE len > 1),
c AS (SELECT k.lang, k.phrase, k.len, k.a, k, x.a AS l, y.a AS r, ({SCALE}::HUGEINT * k.a) // (x.a::HUGEINT + y.a) AS score FROM k
      JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(p[1:k], ' ')
      JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(p[k + 1 : k.len], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
e AS (SELECT *, string_split(phrase, ' ') AS p, unnest(range(1, len + 1)) AS i FROM f WHERE len > 2),
h AS (SELECT lang, array_to_string(p[i : i + m - 1], ' ') AS phrase, max(a) AS longer
      FROM e, (SELECT unnest([2, 3]) AS m) WHERE m < len AND i + m - 1 <= len GROUP BY ALL),
z AS (SELECT b.* FROM b LEFT JOIN h USING (lang, phrase) WHERE longer IS NULL OR longer::HUGEINT * {COVERED[1]} < a::HUGEINT * {COVERED[0]}),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM q JOIN n USING (lang) WHERE rank <= {FIRST}
"""
