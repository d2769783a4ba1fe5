"""Token counts of a byte-fallback BPE of the ``sentencepiece`` library, by rank-synchronous merging of arrays.

The library normalises a text. It is cut into pre-tokens, white space in front of what follows it, where no piece of the vocabulary
can reach across. Pre-tokens that the worker's memo lacks are merged together: their symbols lie in one flat numpy array with a
sequence number beside each, and in every round each sequence applies its lowest-rank pair, at all places at once. What counts is the
number of symbols that survive; a character that the vocabulary lacks counts as its UTF-8 bytes.

The library merges one place at a time, the leftmost first. That is the same unless a merge gives rise to a pair of a rank that
isn't higher, which is looked for in every round; the few sequences where it happens are merged place by place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import text_batches

LIMIT = 4096
SPACE = "▁"
# Pre-tokens that one Python worker remembers, their characters together, and the longest kept; at a limit it keeps those it has.
MEMO, MEMO_CHARS, MEMO_LONGEST = 1_000_000, 32_000_000, 256
# Characters that are normalised text of one slice, and that are merged in one go.
SLICE, FLAT = 1 << 20, 1 << 18
_NONE = 1 << 40


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Symbols of a model as numbers, and which pairs of them merge.

    Symbols are the pieces, the characters that occur in pieces only, and one for each byte length of all other characters.
    """

    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        lib = self.library
        every = range(lib.vocab_size())
        if not any(map(lib.is_byte, every)) or any(map(lib.is_unused, every)):
            raise ValueError("the model must fall back to bytes and use all its pieces")
        plain = [i for i in every if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i))]
        pieces = [lib.id_to_piece(i) for i in plain]
        score = dict(zip(pieces, map(lib.get_score, plain)))
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        names = pieces + sorted({c for p in pieces for c in p} - score.keys())
        number = {p: i for i, p in enumerate(names)}
        self.size = len(names) + 4
        # Tokens that a symbol counts for.
        self.weight = np.array([1 if p in score else len(p.encode()) for p in names] + [1, 2, 3, 4], np.int64)
        points = np.arange(0x110000)
        self.symbol = (len(names) + (points > 0x7F).astype(np.int32) + (points > 0x7FF) + (points > 0xFFFF)).astype(np.int32)
        for c, i in number.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        found = [(number[p[:k]] * self.size + number[p[k:]], order[score[p]], number[p]) for p in pieces for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        found.sort()
        self.pair, self.rank, self.merged = (np.array(x, np.int64) for x in zip(*found, (_NONE, _NONE, 0)))
        # Neighbours inside some piece; nothing merges across any others.
        self.inside = np.unique(np.array([number[a] * self.size + number[b] for p in pieces for a, b in zip(p, p[1:])], np.int64))
        reaches = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.cut = re.compile("(?s).+" if reaches else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.apart = not reaches

    def places(self, pairs):
        """Place and presence of pairs in the sorted table."""
        import numpy as np

        at = np.searchsorted(self.pair, pairs)
        return at, self.pair[at] == pairs


def in_order(vocabulary: Vocabulary, symbols: list[int]) -> int:
    """Tokens of one sequence, merged place by place: lowest rank first, then leftmost."""
    import heapq

    if not hasattr(vocabulary, "table"):
        vocabulary.table = dict(zip(vocabulary.pair.tolist(), zip(vocabulary.rank.tolist(), vocabulary.merged.tolist())))
    table, size, n = vocabulary.table, vocabulary.size, len(symbols)
    now, after, before, heap = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (hit := table.get(now[i] * size + now[after[i]])):
            heapq.heappush(heap, (hit[0], i, now[i], now[after[i]], hit[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = after[i]
        if now[i] != a or j >= n or now[j] != b:
            continue
        now[i], now[j], after[i] = made, -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return sum(int(vocabulary.weight[s]) for s in now if s >= 0)


def merge(vocabulary: Vocabulary, words: list[str]):
    """The number of tokens of each pre-token."""
    import numpy as np

    lengths = np.fromiter(map(len, words), np.int64, len(words))
    start = vocabulary.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)].astype(np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    # Sequences: pre-tokens, cut once more between neighbours that no piece has.
    near = start[:-1] * vocabulary.size + start[1:]
    at = np.minimum(np.searchsorted(vocabulary.inside, near), len(vocabulary.inside) - 1)
    first = np.concatenate([[True], (vocabulary.inside[at] != near) | (owner[:-1] != owner[1:])]) if len(start) else np.zeros(0, bool)
    seq = np.cumsum(first) - 1
    starts, total = np.flatnonzero(first), int(first.sum())
    tokens, odd = np.zeros(total, np.int64), np.zeros(total, bool)
    last = np.full(total, -1, np.int64)
    symbols = start
    while len(symbols):
        at, hit = vocabulary.places(symbols[:-1] * vocabulary.size + symbols[1:])
        hit &= seq[:-1] == seq[1:]
        rank = np.append(np.where(hit, vocabulary.rank[at], _NONE), _NONE)
        head = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        least = np.minimum.reduceat(rank, head)
        names = seq[head]
        odd[names[least <= last[names]]] = True
        last[names] = least
        done = (least == _NONE) | odd[names]
        over = np.repeat(done, np.diff(np.append(head, len(seq))))
        if done.any():
            tokens += np.bincount(seq[over], vocabulary.weight[symbols[over]], total).astype(np.int64)
        best = np.repeat(least, np.diff(np.append(head, len(seq))))
        chosen = (rank == best) & ~over
        # Of places that overlap, every second one from the left.
        i = np.arange(len(chosen))
        opens = chosen & ~np.append(False, chosen[:-1])
        chosen &= (i - np.maximum.accumulate(np.where(opens, i, 0))) % 2 == 0
        left = np.flatnonzero(chosen)
        made = vocabulary.merged[at[left]]
        # The next place starts right behind: would the new symbol rather merge with what stands there?
        touching = np.flatnonzero(left[1:] == left[:-1] + 2)
        touching = touching[seq[left[touching]] == seq[left[touching + 1]]]
        if len(touching):
            a, there = vocabulary.places(made[touching] * vocabulary.size + symbols[left[touching + 1]])
            bad = there & (vocabulary.rank[a] <= rank[left[touching]])
            odd[seq[left[touching[bad]]]] = True
        symbols = symbols.copy()
        symbols[left] = made
        keep = ~over
        keep[left + 1] = False
        symbols, seq = symbols[keep], seq[keep]
    ends = np.append(starts[1:], len(start))
    for s in np.flatnonzero(odd).tolist():
        tokens[s] = in_order(vocabulary, start[starts[s] : ends[s]].tolist())
    return np.bincount(owner[starts], tokens, len(words)).astype(np.int64)


class Counter:
    """Count tokens of texts; remembers the counts of short pre-tokens."""

    def __init__(self, path: str, memo: int = MEMO, chars: int = MEMO_CHARS):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, int] = {}
        self.room, self.chars = memo, chars

    def _slices(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a normalised text, those of about a million characters at a time."""
        start = 0
        while self.vocabulary.apart and len(text) - start > SLICE:
            end = start + SLICE
            while 0 < end < len(text) and not (text[end] == SPACE and text[end - 1] != SPACE):
                end = text.find(SPACE, end + 1)
            if not 0 < end < len(text):
                break
            yield self.vocabulary.cut(text[start:end])
            start = end
        yield self.vocabulary.cut(text[start:] if start else text)

    def _add(self, words: set[str]) -> dict[str, int]:
        found, part, size = {}, [], 0
        for w in [*words, None]:
            if part and (w is None or size + len(w) > FLAT):
                found.update(zip(part, merge(self.vocabulary, part).tolist()))
                part, size = [], 0
            if w is not None:
                part.append(w)
                size += len(w)
        for w, n in found.items():
            if self.room > 0 and len(w) <= min(MEMO_LONGEST, self.chars):
                self.known[w] = n
                self.room, self.chars = self.room - 1, self.chars - len(w)
        return found

    def count(self, texts: list[str]) -> list[int]:
        totals, known = [0] * len(texts), self.known
        waiting, missing, size = [], set(), 0

        def settle() -> None:
            found = self._add(missing)
            for i, words in waiting:
                totals[i] += sum([known.get(w) or found[w] for w in words])
            waiting.clear()
            missing.clear()

        for i, text in enumerate(texts):
            for words in self._slices(self.vocabulary.library.normalize(text)):
                waiting.append((i, words))
                missing.update(w for w in set(words) if w not in known)
                size += sum(map(len, words)) if len(words) < 64 else len(words) * 6
                if size > SLICE:
                    settle()
                    size = 0
        settle()
        return totals


@cache
def counter(path: str) -> Counter:
    """The counter of this Python worker; its memo lives as long as the worker."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    Counts are those of the library without begin and end tokens; names of special tokens inside a text are plain text. Null and
    empty texts have 0 bytes and 0 tokens. Repeated rows stay, ids aren't looked at, an empty table gives no rows, other
    columns are ignored. ``path`` names the model file on the workers; by default the one of the installed tokenizers.
    """

    def run(batches) -> Iterator:
        import pyarrow as pa

        found = counter(path or default_path())
        for whole in batches:
            for batch in text_batches(whole):
                counts = found.count([t or "" for t in batch.column(2).to_pylist()])
                made = pa.array(counts, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["doc_id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size, "text")
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
