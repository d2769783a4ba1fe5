"""Source divergence audit: how far each source of a language differs from the others, over the terms that are common there.

The common terms of a language are found by iceberg prefix refinement. A pass over the texts counts, for every byte prefix of some
length, the documents that have it; prefixes below the threshold are discarded, and the next pass extends only those that
remain, to four times the length. Terms that end within a level are complete there. As no term is in more documents than its
prefix, no common term is lost. In these passes a prefix is a 64-bit hash with its language, and tasks know what remains by a bitmap
of fixed size: prefixes that meet in either let a rare one pass, never the other way round. When complete terms remain only, a last pass counts
them by their bytes, and these counts decide.

A group gives a share to every common term of its language, also to those it lacks. Groups without a term all give it the same share,
so sums over all terms are put together from the terms that occur.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import text_batches

THRESHOLD = 10
TOP = 10
# Bytes of the prefixes of the first level, and how much longer those of the next one are.
FIRST, LONGER = 8, 4
# Bits of the bitmap of remaining prefixes: 4 MB, whatever the input.
BITS = 1 << 25
# Bytes of text that a task counts at a time; longer texts are taken in slices.
HELD = 1 << 23
# Counts by source and terms that a task holds before it hands them on.
ROWS_HELD, TERMS_HELD = 1_000_000, 400_000
UNIT = 1_000_000_000
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def slices(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end where a term does."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + size) if len(data) - start > size else -1
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


class Words:
    """The terms of some bytes, as places and lengths: runs of ASCII letters, lower-cased, and of bytes beyond ASCII."""

    def __init__(self, data: bytes):
        import numpy as np

        self.data = data
        letters = np.frombuffer(b" " + data + b" ", np.uint8) != 0x20
        edges = np.flatnonzero(letters[1:] != letters[:-1])
        self.start, self.length = edges[::2], edges[1::2] - edges[::2]
        # Eight bytes from any place on as one number.
        self.eight = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))

    def keep(self, chosen) -> None:
        self.start, self.length = self.start[chosen], self.length[chosen]

    def chunk(self, chosen, at: int, upto: int):
        """Bytes ``at`` to ``at + 8`` of the chosen terms, but none from ``upto`` on; missing ones are 0, which no term has."""
        import numpy as np

        many = np.clip(np.minimum(self.length[chosen], upto) - at, 0, 8).astype(np.uint64)
        mask = np.where(many == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (many % np.uint64(8) * np.uint64(8))) - np.uint64(1))
        return self.eight[self.start[chosen] + at].astype(np.uint64) & mask

    def keys(self, seed: int, upto: int):
        """A 64-bit hash of the first ``upto`` bytes of each term, or of the whole term if that is shorter."""
        import numpy as np

        made, live, at = np.full(len(self.start), seed, np.uint64), np.arange(len(self.start)), 0
        while len(live) and at < upto:
            h = (made[live] ^ self.chunk(live, at, upto)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            made[live] = h ^ (h >> np.uint64(32))
            at += 8
            live = live[self.length[live] > at]
        return made

    def numbers(self):
        """Equal numbers for equal terms: eight bytes after eight, those with the same number so far and the same next bytes stay together."""
        import numpy as np

        found, live, at, used = np.zeros(len(self.start), np.int64), np.arange(len(self.start)), 0, 0
        while len(live):
            _, both = np.unique(self.chunk(live, at, at + 8), return_inverse=True)
            if at:
                _, both = np.unique(found[live] * (int(both.max()) + 1) + both, return_inverse=True)
            found[live] = both + used
            used += int(both.max()) + 1
            at += 8
            live = live[self.length[live] > at]
        return found

    def at(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.length[i]]


def _seed(lang: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(lang, 42)


def _among(keys, remaining: bytes):
    import numpy as np

    bits = np.frombuffer(remaining, np.uint8)
    at = keys >> np.uint64(1) & np.uint64(8 * len(remaining) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def windows(batches, held: int) -> Iterator[tuple[str, list[str], list[bytes]]]:
    """``lang, sources, texts`` of documents of one language, about ``held`` bytes; a longer text comes alone."""
    waiting: dict[str, tuple[list[str], list[bytes]]] = {}
    size = 0
    for whole in batches:
        for batch in text_batches(whole):
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode().translate(_PLAIN)
                if len(data) > held:
                    yield lang, [source], [data]
                    continue
                sources, texts = waiting.setdefault(lang, ([], []))
                sources.append(source)
                texts.append(data)
                size += len(data)
                if size >= held:
                    yield from ((k, *v) for k, v in waiting.items())
                    waiting, size = {}, 0
    yield from ((k, *v) for k, v in waiting.items())


def _documents(words: Words, texts: list[bytes]):
    """The place in ``texts``, joined by blanks, of the document of each term."""
    import numpy as np

    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.searchsorted(ends, words.start, side="right")


def read(docs: DataFrame) -> DataFrame:
    """``lang, source, text`` with nulls as empty strings."""
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def level_counts(rows: DataFrame, length: int, below: int = 0, remaining: bytes | None = None, held: int = HELD) -> DataFrame:
    """``key, docs``: documents of each open prefix of ``length`` bytes and of each shorter term, by their hash with the language.

    The lowest bit of a key says whether it is an open prefix.
    Only what is at least ``below`` bytes long counts, and only if its prefix of that length may be among the remaining ones. Tasks count a
    bounded part of the texts at a time, so a key comes several times.
    """

    def found(words: Words, lang: str):
        import numpy as np

        seed = _seed(lang)
        if below:
            words.keep(words.length >= below)
            words.keep(_among(words.keys(seed, below), remaining))
        return words.keys(seed, length) & ~np.uint64(1) | (words.length >= length).astype(np.uint64)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for lang, _, texts in windows(batches, held):
            if len(texts) == 1:  # maybe a long one: its distinct keys, slice by slice
                parts = [np.unique(found(Words(part), lang)) for part in slices(texts[0], held)]
                keys = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
                docs = np.ones(len(keys), np.int64)
            else:
                words = Words(b" ".join(texts))
                keys, back = np.unique(found(words, lang), return_inverse=True)
                pairs = np.unique(_documents(words, texts) << 32 | back)
                docs = np.bincount(pairs & 0xFFFFFFFF, minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(docs)], names=["key", "docs"])

    return rows.mapInArrow(run, "key long, docs long")


def bitmap(keys: DataFrame, bits: int = BITS) -> bytes:
    """One bit for each ``key``, by what stands above its lowest bit, built by Spark and handed to the driver in blocks of 4 KB."""
    blocks = keys.select(F.shiftrightunsigned("key", 1).bitwiseAND(F.lit(bits - 1)).alias("bit")).groupBy(F.shiftright("bit", 15).alias("block"))
    made = bytearray(bits // 8)
    for r in blocks.agg(F.bitmap_construct_agg(F.col("bit") % (1 << 15)).alias("bits")).collect():
        made[r.block << 12 : (r.block + 1) << 12] = r.bits
    return bytes(made)


def term_counts(rows: DataFrame, longest: int, kept: bytes, held: int = HELD, rows_held: int = ROWS_HELD, terms_held: int = TERMS_HELD) -> DataFrame:
    """``lang, source, term, docs, n``: documents and occurrences of the terms shorter than ``longest`` whose hash may be among the kept ones.

    A task adds up the counts of the parts of its text until it holds many, so a key comes a few times at most.
    """

    def run(batches) -> Iterator:
        from collections import Counter, defaultdict

        import numpy as np
        import pyarrow as pa

        kinds = {"lang": pa.string(), "source": pa.string(), "term": pa.binary(), "docs": pa.int64(), "n": pa.int64()}
        terms: dict[bytes, int] = defaultdict(lambda: len(terms))
        groups: dict[tuple[str, str], int] = defaultdict(lambda: len(groups))
        waiting: list[tuple] = []  # group and term as one number, documents, occurrences

        def chosen(data: bytes, lang: str) -> Words:
            words = Words(data)
            words.keep(words.length < longest)
            words.keep(_among(words.keys(_seed(lang), longest), kept))
            return words

        def summed() -> int:
            if len(waiting) > 1:
                keys, docs, n = (np.concatenate(x) for x in zip(*waiting))
                order = np.argsort(keys, kind="stable")
                keys = keys[order]
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
                waiting[:] = [(keys[first], np.add.reduceat(docs[order], first), np.add.reduceat(n[order], first))] if len(keys) else []
            return sum(len(k) for k, _, _ in waiting)

        def hand_on() -> Iterator:
            summed()
            names, labels = list(terms), list(groups)
            for keys, docs, n in waiting:
                for i in range(0, len(keys), 50_000):
                    part = keys[i : i + 50_000]
                    group, term = (part >> 32).tolist(), (part & 0xFFFFFFFF).tolist()
                    columns = [[labels[g][0] for g in group], [labels[g][1] for g in group], [names[t] for t in term], docs[i : i + 50_000], n[i : i + 50_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))
            waiting.clear()
            terms.clear()
            groups.clear()

        for lang, sources, texts in windows(batches, held):
            if len(texts) == 1:
                total: Counter[bytes] = Counter()
                for part in slices(texts[0], held):
                    words = chosen(part, lang)
                    total.update(words.at(i) for i in range(len(words.start)))
                keys = np.array([groups[lang, sources[0]] << 32 | terms[t] for t in total], np.int64)
                waiting.append((keys, np.ones(len(keys), np.int64), np.array(list(total.values()), np.int64)))
            else:
                words = chosen(b" ".join(texts), lang)
                if not len(words.start):
                    continue
                doc, term = _documents(words, texts), words.numbers()
                place = np.full(int(term.max()) + 1, -1, np.int64)
                place[term] = np.arange(len(term))  # some place of each term
                own = np.full(len(place), -1, np.int64)
                used = np.flatnonzero(place >= 0)
                own[used] = [terms[words.at(i)] for i in place[used].tolist()]
                # Documents in order, so that equal pairs of document and term are counted first, then these by source.
                pairs, times = np.unique(doc << 32 | own[term], return_counts=True)
                source = np.array([groups[lang, x] for x in sources], np.int64) << 32
                keys = source[pairs >> 32] | pairs & 0xFFFFFFFF
                order = np.argsort(keys)
                keys = keys[order]
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                docs, n = np.diff(np.append(first, len(keys))), np.add.reduceat(times[order], first)
                keys = keys[first]
                waiting.append((keys, docs, n))
            if sum(len(k) for k, _, _ in waiting) > rows_held and summed() > rows_held or len(terms) > terms_held:
                yield from hand_on()
        yield from hand_on()

    return rows.mapInArrow(run, "lang string, source string, term binary, docs long, n long")


def common_terms(rows: DataFrame, scratch: Scratch, threshold: int = THRESHOLD, first: int = FIRST, held: int = HELD, bits: int = BITS, **counts_held: int) -> DataFrame:
    """``lang, source, term, n``: occurrences by source of the terms that at least ``threshold`` documents of the language have."""
    below, length, remaining, ended = 0, first, None, []
    while True:
        counted = level_counts(rows, length, below, remaining, held).groupBy("key").agg(F.sum("docs").alias("docs"))
        counted = scratch.save(counted.where(F.col("docs") >= threshold).select("key"), f"level{length}")
        open_ = F.col("key").bitwiseAND(F.lit(1)) == 1
        ended.append(counted.where(~open_))
        extended = counted.where(open_)
        if not extended.limit(1).count():
            break
        remaining, below, length = bitmap(extended, bits), length, LONGER * length
    complete = ended[0]
    for part in ended[1:]:
        complete = complete.unionAll(part)
    counts = term_counts(rows, length, bitmap(complete, bits), held, **counts_held).groupBy("lang", "source", "term")
    counts = scratch.save(counts.agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")), "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= threshold).select("lang", "term")
    return counts.join(kept, ["lang", "term"]).select("lang", "source", F.col("term").cast("string").alias("term"), "n")


def share(n: Column, total: Column, terms_: Column) -> Column:
    """The share of a term in billionths, plus one: ``1 + floor(10^9 * (n + 2) / (total + 2 * terms))``, exact.

    Computed in longs as long as the product fits, in decimals beyond.
    """
    wide = [c.cast("decimal(20,0)") for c in (n, total, terms_)]
    small = F.call_function("div", (n + 2) * F.lit(UNIT).cast("long"), F.nullif(total + terms_ * 2, F.lit(0).cast("long")))
    large = F.call_function("div", (wide[0] + 2) * F.lit(UNIT).cast("decimal(10,0)"), F.nullif(wide[1] + wide[2] * 2, F.lit(0)))
    return F.when(n < F.lit((1 << 63) // UNIT - 3), small).otherwise(large) + 1


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; shares are at most 10^9 + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def shared_terms(shares: DataFrame) -> DataFrame:
    """``lang, source, item, shared``: per pair of sources, source before item, sums over the terms of both of what their gaps differ from those against a lack.

    ``shares`` has ``lang, term, source, p, lacking``, one row for each. All sources of a term come together, so tasks read them in order and sum up the
    pairs that are 1, 2, ... rows apart; a pair of sources comes once for each part that a task reads.
    """

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def gaps(p, q):
            return (p - q) * (p - q) // (p + q)

        def sums(rows):
            langs, terms, sources = (rows.column(k).dictionary_encode() for k in range(3))
            group = langs.indices.to_numpy().astype(np.int64) * len(terms.dictionary) + terms.indices.to_numpy()
            lang, source = (x.indices.to_numpy().astype(np.int64) for x in (langs, sources))
            p, p0 = (rows.column(k).to_numpy() for k in (3, 4))
            wide, keys, values = len(sources.dictionary), [], []
            for d in range(1, rows.num_rows):
                i = np.flatnonzero(group[d:] == group[:-d])
                if not len(i):
                    break
                j = i + d
                values.append(gaps(p[i], p[j]) - gaps(p[i], p0[j]) - gaps(p0[i], p[j]) + gaps(p0[i], p0[j]))
                keys.append((lang[i] * wide + source[i]) * wide + source[j])
                if sum(map(len, keys)) > 1 << 20:
                    yield made(np.concatenate(keys), np.concatenate(values), langs.dictionary, sources.dictionary)
                    keys, values = [], []
            if keys:
                yield made(np.concatenate(keys), np.concatenate(values), langs.dictionary, sources.dictionary)

        def made(keys, values, langs, sources):
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            total, keys, wide = np.add.reduceat(values, first), keys[first], len(sources)
            columns = [langs.take(pa.array(keys // (wide * wide))), sources.take(pa.array(keys // wide % wide)), sources.take(pa.array(keys % wide))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(total)], names=["lang", "source", "item", "shared"])

        # The rows of the last term wait for the next batch, which may go on with it.
        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if waiting is None else [waiting, batch]).combine_chunks().to_batches()[0]
            last = (table.column(0)[-1].as_py(), table.column(1)[-1].as_py())
            cut = table.num_rows - 1
            while cut > 0 and (table.column(0)[cut - 1].as_py(), table.column(1)[cut - 1].as_py()) == last:
                cut -= 1
            if cut:
                yield from sums(table.slice(0, cut))
            waiting = table.slice(cut)
        if waiting is not None:
            yield from sums(waiting)

    rows = shares.select("lang", "term", "source", "p", "lacking").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return rows.mapInArrow(run, "lang string, source string, item string, shared long")


def divergence(docs: DataFrame, scratch: Scratch, threshold: int = THRESHOLD, top: int = TOP, **rules) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source) group of ``docs``.

    Part ``pair``: every other source of the language with the sum of gaps over all common terms, 0 if there are none. Part ``term``: the
    ``top`` terms that are more frequent in the group than in the language, by gap. Null text, lang and source count as empty
    strings, a row is a document whatever its id, repeated rows count again. An empty table gives no rows; other columns are ignored.
    """
    rows = read(docs)
    found = scratch.save(common_terms(rows, scratch, threshold, **rules), "common")
    overall = found.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    langs = overall.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total"))
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = rows.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *map(zero, ("terms", "total", "own")))
    lacking = share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    groups = scratch.save(groups.withColumn("lacking", F.when(F.col("terms") > 0, lacking)), "groups")
    known = groups.select("lang", "source", "terms", "total", "lacking")
    shares = found.join(known, ["lang", "source"])
    shares = scratch.save(shares.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "lacking"), "shares")

    usual = overall.join(langs, "lang").select("lang", "term", share(F.col("all"), F.col("lang_total"), F.col("terms")).alias("q"))
    above = shares.join(usual, ["lang", "term"]).where("p > q")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    peaks = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    peaks = peaks.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    # Terms of one side as if the other side lacked them all; equal counts have equal shares, so they are taken together.
    sides = groups.select("lang", F.col("source").alias("item"), F.col("lacking").alias("other"), F.col("own").alias("other_own"))
    steps = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    alone = steps.join(sides, "lang").where("source <> item").groupBy("lang", "source", "item")
    alone = scratch.save(alone.agg(F.sum(F.col("times") * gap(F.col("p"), F.col("other"))).alias("alone")), "alone")
    # What that misses for the terms of both.
    both = scratch.save(shared_terms(shares).groupBy("lang", "source", "item").agg(F.sum("shared").alias("shared")), "shared")
    both = both.unionAll(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "shared"))
    pairs = groups.select("lang", "source", "terms", "own", "lacking").join(sides, "lang").where("source <> item")
    back = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("back"))
    on = ["lang", "source", "item"]
    pairs = pairs.join(alone, on, "left").join(back, on, "left").join(both, on, "left")
    neither = (F.col("terms") - F.col("own") - F.col("other_own")) * gap(F.col("lacking"), F.col("other"))
    value = sum((F.coalesce(c, F.lit(0).cast("long")) for c in (F.col("alone"), F.col("back"), F.col("shared"))), F.coalesce(neither, F.lit(0).cast("long")))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return pairs.withColumn("rank", F.row_number().over(best)).unionAll(peaks)


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {THRESHOLD}),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT s.*, 1 + ({UNIT}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM s JOIN v USING (lang)),
l AS (SELECT lang, term, sum(n) AS n FROM s GROUP BY ALL),
q AS (SELECT l.lang, term, 1 + ({UNIT}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY l.lang) + 2 * v) AS q FROM l JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
peaks AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value,
         row_number() OVER (PARTITION BY lang, source ORDER BY coalesce(value, 0) DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value::BIGINT, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM peaks)
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
