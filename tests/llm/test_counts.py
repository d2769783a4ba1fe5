"""Phrases, token counts and source divergence against SQL, the library and brute force."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from rentledger.llm import collocations, divergence, queries, tokencount
from rentledger.llm.common import Scratch

WORDS = "the Of and rental bike boat price für été NIÑO x42y don't re-use a b c d".split()


def text_of(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice([""] * 12 + [".", ",", ";\n", "\t", "\r\n", "  ", "\x1c", "\xa0"]) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Nulls, empty and long texts, repeated rows and ids, languages without phrases or terms, sources that lack every term."""
    top, rnd = tmp_path_factory.mktemp("counts"), random.Random(5)
    rows = [(i, text_of(rnd, rnd.randrange(0, 500)), rnd.choice(["en", "en", "de", None]), rnd.choice(["s1", "s1", "s1", "s2", "é", None])) for i in range(260)]
    rows += [(1, None, "en", "s1"), (2, "", None, None), (None, "a b c d " * 3000, "en", "hot"), (3, " \t\n", "fr", "s1"), (3, "0 1 2", "fr", "s2"), (4, "Word", "", "")]
    rows += [rows[7]] * 9 + [(5, "x" * 90_000 + " the of " * 50, "en", "s2"), (6, "日本語 the of 日本語 the of", "zh", "s1"), (7, "<|endoftext|> </s> a\x00b 😀", "en", "only")]
    rows += [(8, "Über-Wort 日本 a\x00b", "zh", f"s{i % 3}") for i in range(12)]
    schema = "doc_id long, text string, lang string, source string, term string, n int, p int, part string, phrase string, rank int"
    spark.createDataFrame([(*r, "x", 1, 2, "y", "z", 3) for r in rows], schema).repartition(5).write.parquet(f"{top}/documents.parquet")
    return str(top)


def by_sql(folder, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con.execute(sql).fetchall()


def table(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name", ["op11_collocations", "op13_source_divergence"])
def test_sql(spark, folder, name):
    for at in (folder, "/root/testdata/sf0.001"):
        got = queries.QUERIES[name](spark, at)
        sql = f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]})"
        want = by_sql(folder, sql) if at == folder else duckdb.sql(sql.replace("FROM documents", f"FROM '{at}/documents.parquet'")).fetchall()
        assert Counter(map(tuple, got.collect())) == Counter(want) and len(want) > 10


# --- phrases --------------------------------------------------------------------------------------


def test_summaries_that_overflow_lose_no_frequent_phrase(spark, folder):
    """Few counters, windows and filter bits: keys are taken from, hits are false, and the result is the same."""
    docs, want = table(spark, folder), None
    for sizes in ({}, {"counters": 4, "bits": 1 << 20, "window": 500, "remembered": 10}, {"counters": 2, "bits": 1 << 15, "window": 97}):
        got = sorted(map(tuple, collocations.collocations(docs.repartition(1), Scratch(spark, "t"), first=None, **sizes).collect()))
        assert want is None or got == want
        want = got
    assert len(want) > 100


def test_misra_gries_keeps_what_is_frequent():
    rnd = np.random.default_rng(3)
    for _ in range(20):
        stream = np.concatenate([rnd.integers(0, 1 << 32, 4000, dtype=np.uint32), np.repeat(rnd.integers(0, 1 << 32, 30, dtype=np.uint32), rnd.integers(25, 60, 30))])
        rnd.shuffle(stream)
        true, parts, mass = Counter(stream.tolist()), [], 0
        for piece in np.array_split(stream, 40):
            prints, counts = np.unique(piece, return_counts=True)
            mass += int(np.minimum(counts, 30).sum())
            parts.append(collocations.packed(prints, np.minimum(counts, 30)))
        summary = collocations.Summary(mass // 30 + 1)
        for blob in parts:
            summary.add(blob)
        kept = set(summary.frequent(30).tolist())
        assert summary.taken > 0 and len(summary.prints) <= summary.counters
        assert {k for k, n in true.items() if n >= 30} <= kept and len(kept) < 200


def test_long_texts_are_split_where_words_end():
    text, words = "One two,three\tfour " * 200_000, collocations.Words()
    found = collocations.numbers(text, words)
    assert [words.names[i].decode() for i in found[:6]] == ["one", "two", "\n", "three", "four", "one"] and len(found) == 5 * 200_000 + 1


# --- token counts ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokencount.default_path())


def test_op12(spark, folder, library):
    rows = [(r.doc_id, r.text or "") for r in table(spark, folder).collect()]
    want = Counter((d, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for d, t in rows)
    assert Counter(map(tuple, queries.QUERIES["op12_token_counts"](spark, folder).collect())) == want
    assert sum(over for *_, over in want) == 2


def test_counts_are_the_librarys(library):
    rnd, pieces = random.Random(2), library.vocab_size()
    texts = ["", " ", "   ", " " * 1000, "a" * 5000, "<s> </s> <unk> <0x0A>", "▁▁a ▁ b▁", "a\x00b\tc\n\n\r", "aaab" * 100, "nana" * 50 + "ACACAC" * 30, "﻿x​ é é 日本語 😀" * 9]
    texts += ["".join(rnd.choice(" ab▁n-=*.e") for _ in range(rnd.randrange(1, 80))) for _ in range(2000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(32, 0xD7FF)])) for _ in range(rnd.randrange(1, 50))) for _ in range(1000)]
    texts += ["".join(library.id_to_piece(rnd.randrange(259, pieces)) for _ in range(rnd.randrange(1, 8))) for _ in range(3000)]
    want = [len(x) for x in library.encode(texts)]
    assert tokencount.Counter(tokencount.default_path()).count(texts) == want
    assert tokencount.Counter(tokencount.default_path(), memo=5, chars=20).count(texts) == want


def test_symbols_are_merged_place_by_place_where_order_matters(library):
    """The strict way alone gives the library's counts, and the array way the same wherever it isn't flagged."""
    vocabulary, rnd = tokencount.Vocabulary(tokencount.default_path()), random.Random(4)
    words = ["▁" + "".join(rnd.choice("abehinrst") for _ in range(rnd.randrange(1, 40))) for _ in range(500)] + ["▁" * n for n in range(1, 40)]
    strict = [tokencount.in_order(vocabulary, vocabulary.symbol[[ord(c) for c in w]].tolist()) for w in words]
    assert tokencount.merge(vocabulary, words).tolist() == strict == [len(library.encode(w.replace("▁", " ")[1:])) for w in words[:500]] + strict[500:]


def test_long_texts_are_cut_between_pre_tokens(library, monkeypatch):
    monkeypatch.setattr(tokencount, "SLICE", 50)
    monkeypatch.setattr(tokencount, "FLAT", 64)
    rnd = random.Random(6)
    texts = [text_of(rnd, 400) + " " * 120 + "x" * 300, "  lead" * 40, "no-space" * 40]
    assert tokencount.Counter(tokencount.default_path()).count(texts) == [len(library.encode(t)) for t in texts]


# --- divergence -----------------------------------------------------------------------------------


def test_refinement_by_any_steps(spark, folder):
    """First levels of 1 and 40 bytes, small shares of the text at a time and a bitmap full of false hits find the same terms."""
    rows = divergence.read(table(spark, folder))
    want = sorted(map(tuple, divergence.common_terms(rows, Scratch(spark, "t")).collect()))
    brute, seen = Counter(), Counter()
    for r in rows.collect():
        words = [w.decode() for w in r.text.encode().translate(divergence._PLAIN).split()]
        brute.update((r.lang, r.source, w) for w in words)
        seen.update((r.lang, w) for w in set(words))
    assert want == sorted((*k, n) for k, n in brute.items() if seen[k[0], k[2]] >= 10) and len(want) > 50
    for first in (1, 40):
        assert sorted(map(tuple, divergence.common_terms(rows, Scratch(spark, "t"), first=first, held=1000, bits=1 << 15, rows_held=500 * first, terms_held=300).collect())) == want


def test_words_as_numbers():
    rnd = random.Random(9)
    text = " ".join("".join(rnd.choice("aé日") for _ in range(rnd.randrange(1, 30))) for _ in range(3000)) + "- x,Y\x00z  "
    data = text.encode().translate(divergence._PLAIN)
    words, plain = divergence.Words(data), data.split()
    assert [words.at(i) for i in range(len(words.start))] == plain
    groups = lambda numbers, names: len({(n, w) for n, w in zip(numbers.tolist(), names)}) == len(set(numbers.tolist())) == len(set(names))
    assert groups(words.numbers(), plain)
    for upto in (1, 3, 8, 11, 16, 200):
        assert groups(words.keys(7, upto), [w[:upto] for w in plain])
    assert b"".join(divergence.slices(data, 50)) == data
    assert not len(divergence.Words(b"").start) and not len(divergence.Words(b"   ").numbers())


def test_shares_are_exact_beyond_longs(spark):
    rows = [(n, t, v) for n in (0, 7, 9_223_372_033, 9_223_372_034, 10**15) for t in (n, 3 * n + 1) for v in (1, 10**9)]
    df = spark.createDataFrame(rows, "n long, t long, v long")
    got = [r[0] for r in df.select(divergence.share(df.n, df.t, df.v)).collect()]
    assert got == [1 + 10**9 * (n + 2) // (t + 2 * v) for n, t, v in rows]
