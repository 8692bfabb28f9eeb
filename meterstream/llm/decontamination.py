"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are folded to lower-case letters and digits with one
blank between words.  If a region of a text is within ``k`` edits of an item
of ``m`` characters, it shares at least ``m - q + 1 - k q`` q-grams with it,
all on ``k + 1`` neighbouring diagonals.  Shared q-grams are counted in bands
of diagonals that overlap by ``k``, so that such a region lies whole in one
band; bands that reach the bound are verified by an alignment confined to
their diagonals.

Regions begin and end at word bounds, so that no item is found inside a word;
in scripts without blanks between words each character is bounded.  Items of
fewer than ``q`` characters have no q-gram and are found as they are.

The index of the items is sent to the tasks in blocks of bounded size, one
after another; each is held against all texts, so texts are never shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged

HIT = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()),
                 ("similarity", pa.float64())])
HITS = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int,similarity:double>>"
#: Folded characters of a text handled at a time.
BLOCK = 1 << 20
BLANK, TABLE_BITS = 32, 20
FOLD: list[np.ndarray] = []
#: Scripts without blanks between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana and Han.
UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F), (0x31A0, 0x9FFF), (0xF900, 0xFAFF),
            (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))


def _fold_table() -> np.ndarray:
    """Code point -> code point of its lower-case form; a blank for all but letters and digits."""
    if not FOLD:
        FOLD.append(np.array([ord(chr(c).lower()[0]) if chr(c).isalnum() else BLANK for c in range(0x20000)], np.uint32))
    return FOLD[0]


def folded(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points and the place of each in the text."""
    a = np.frombuffer((text or "").encode("utf-32-le"), "<u4")
    fold = _fold_table()
    a = fold[np.minimum(a, len(fold) - 1)] if a.size and a.max() < len(fold) else np.where(
        a < len(fold), fold[np.minimum(a, len(fold) - 1)], a)
    blank = a == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank of each run
    at = np.flatnonzero(keep)
    if at.size and a[at[-1]] == BLANK:
        at = at[:-1]
    if at.size and a[at[0]] == BLANK:
        at = at[1:]
    return a[at], at


def word_bounds(a: np.ndarray) -> np.ndarray:
    """Whether a word can begin or end before each character, and after the last."""
    free = a == BLANK
    for low, high in UNSPACED:
        free |= (a >= low) & (a <= high)
    out = np.ones(len(a) + 1, bool)
    out[1:-1] = free[1:] | free[:-1]
    return out


def grams(a: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit number for each q-gram, put together from those of lengths 1, 2, 4, ..."""
    part, n, base = a.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    whole, length = None, 0
    while True:
        if q & n:
            if whole is None:
                whole, length = part, n
            else:
                end = len(a) - length - n + 1
                whole = whole[:end] * np.uint64(base ^ 0x5851F42D4C957F2D | 1) + part[length:length + end]
                whole ^= whole >> np.uint64(31)
                length += n
        if 2 * n > q:
            return whole[:max(0, len(a) - q + 1)] * np.uint64(0xD6E8FEB86659FD93)  # for the leading bits
        part = part[:-n] * np.uint64(base) + part[n:]
        part ^= part >> np.uint64(29)
        base = (base * 0xBF58476D1CE4E5B9 | 1) & (1 << 64) - 1
        n *= 2


class Index:
    """q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int, error: float, least: int):
        self.q, self.ids, self.texts, budget, need = q, [], [], [], []
        short: dict[int, dict[bytes, list[int]]] = {}  # length -> item -> ids
        for item, text in items:
            a, _ = folded(text)
            if len(a) < max(least, 1):
                continue
            if len(a) < q:
                short.setdefault(len(a), {}).setdefault(a.tobytes(), []).append(item)
                continue
            self.ids.append(item)
            self.texts.append(a)
            k = min(int(error * len(a)), (len(a) - q) // q)  # so that the bound is at least 1
            budget.append(k)
            need.append(len(a) - q + 1 - k * q)
        self.short = [(n, of, np.unique(np.concatenate([grams(np.frombuffer(x, a.dtype), n) for x in of])))
                      for n, of in sorted(short.items())]
        self.budget, self.need = np.array(budget, np.int64), np.array(need, np.int64)
        self.longest = max(map(len, self.texts), default=0)
        g = [grams(a, q) for a in self.texts]
        every = np.concatenate(g) if g else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(g)), [len(x) for x in g])
        place = np.concatenate([np.arange(len(x)) for x in g]) if g else item
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.gram, self.first = np.unique(every[order], return_index=True)
        self.first = np.append(self.first, len(every))
        # grams come sorted, so those with equal leading bits stand together
        top = (self.gram >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.bucket = np.searchsorted(top, np.arange(1 << TABLE_BITS)).astype(np.int32)
        self.some = np.zeros(1 << TABLE_BITS, bool)
        self.some[top] = True
        self.deepest = int(np.bincount(top).max()) if len(top) else 0
        self.of_item = [np.searchsorted(self.gram, x) for x in g]

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` of q-grams of the index, and which they are."""
        top = (h >> np.uint64(64 - TABLE_BITS)).view(np.int64)
        at = np.flatnonzero(self.some[top])
        h, top = h[at], top[at]
        k = self.bucket[top]
        same = self.gram[k] == h
        places, grams_ = [at[same]], [k[same]]
        for _ in range(self.deepest - 1):  # few buckets hold more than one
            rest = np.flatnonzero(~same)
            at, h, k = at[rest], h[rest], np.minimum(k[rest] + 1, len(self.gram) - 1)
            same = self.gram[k] == h
            places.append(at[same])
            grams_.append(k[same])
        return np.concatenate(places), np.concatenate(grams_)

    def places_of(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``item`` and ``place`` for the grams ``k``, and how many each has."""
        n = self.first[k + 1] - self.first[k]
        return np.repeat(self.first[k] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()), n

    def candidates(self, a: np.ndarray):
        """(item, lowest diagonal, highest diagonal) of the bands that reach the bound."""
        if not self.need.size:
            return
        at, k = self.known(grams(a, self.q))
        if at.size < self.need.min():
            return
        # an item can only be there if the text holds enough of its q-grams anywhere
        there = np.zeros(len(self.gram), bool)
        there[k] = True
        rows, _ = self.places_of(np.flatnonzero(there))
        enough = np.bincount(self.item[rows], minlength=len(self.ids)) >= self.need
        if not enough.any():
            return
        there[:] = False
        for i in np.flatnonzero(enough):
            there[self.of_item[i]] = True
        at, k = at[there[k]], k[there[k]]
        hit, n = self.places_of(k)
        item, diagonal = self.item[hit].astype(np.int64), np.repeat(at, n) - self.place[hit]
        ok = enough[item]
        item, diagonal, hit = item[ok], diagonal[ok], hit[ok]
        width = self.budget[item] + 1
        band, over = np.divmod(diagonal + self.longest, width)
        low = over < self.budget[item]  # it is in the overlap with the band before
        bands, of = np.unique(np.r_[item, item[low]] * (1 << 40) + np.r_[band, band[low] - 1] + 1, return_inverse=True)
        # of each band the q-grams of the item that it shares, each once
        shared = np.unique(of * np.int64(len(self.place)) + np.r_[hit, hit[low]]) // len(self.place)
        count = np.bincount(shared, minlength=len(bands))
        for x in bands[count >= self.need[bands >> 40]]:
            i, b = int(x >> 40), int(x & (1 << 40) - 1) - 1
            w = int(self.budget[i]) + 1
            yield i, b * w - self.longest, b * w - self.longest + 2 * w - 2


def short_places(a: np.ndarray, index: Index, bound: np.ndarray):
    """(item id, start, end) of the items of under ``q`` characters, between word bounds; places of an item don't overlap."""
    if not index.short:
        return
    for n, ids, known in index.short:
        free: dict[bytes, int] = {}
        for s in range(0, len(a) - n + 1, BLOCK):
            part = a[s:s + BLOCK + n - 1]
            h = grams(part, n)
            for p in np.flatnonzero(bound[s:s + len(h)] & bound[s + n:s + n + len(h)] & np.isin(h, known)) + s:
                x = a[p:p + n].tobytes()
                if x in ids and p >= free.get(x, 0):
                    free[x] = p + n
                    for i in ids[x]:
                        yield i, int(p), int(p) + n


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int,
          bound: np.ndarray | None = None) -> tuple[int, int, int] | None:
    """Fewest edits between the item and a region of the text that starts on a diagonal from ``low`` to ``high``.

    (edits, start, end), or None beyond the budget.  The region begins and ends
    where ``bound`` (for each place of the text and its end) lets it.  The alignment keeps to the
    diagonals ``low - budget`` to ``high + budget``, which none within the
    budget can leave.
    """
    lo, n = low - budget, high - low + 2 * budget + 1
    far, j = 1 << 20, np.arange(n)
    start = np.where((lo + j >= 0) & (lo + j <= len(text)), lo + j, -1)
    if bound is not None:
        start[start >= 0] = np.where(bound[start[start >= 0]], start[start >= 0], -1)
    cost = np.where(start >= 0, 0, far)
    for i, c in enumerate(item):
        here = lo + i + j  # text character that column j compares in this row
        inside = (here >= 0) & (here < len(text))
        differs = np.ones(n, np.int64)
        differs[inside] = text[here[inside]] != c
        across = np.where(inside, cost + differs, far)
        down = np.append(cost[1:], far) + 1  # the item's character is missing in the text
        down[(here < -1) | (here >= len(text))] = far
        down_wins = down < across
        step, begun = np.where(down_wins, down, across), np.where(down_wins, np.append(start[1:], -1), start)
        # more text characters than the item has: a run to the right costs one each
        reach = np.minimum.accumulate(step - j)
        come = np.maximum.accumulate(np.where(step - j == reach, j, 0))
        cost, start = reach + j, begun[come]
        outside = here >= len(text)
        cost[outside] = np.where(step[outside] < far, step[outside], far)
        start[outside] = begun[outside]
        if cost.min() > budget:
            return None
    end = lo + len(item) + j
    cost[(end < 0) | (end > len(text))] = far
    if bound is not None:
        cost[~bound[np.clip(end, 0, len(text))]] = far
    best = int(cost.argmin())
    if cost[best] > budget:
        return None
    return int(cost[best]), int(start[best]), int(lo + len(item) + best)


def find(text: str | None, index: Index) -> list[dict]:
    """The items found in a text, each place once, with offsets in the text as it is."""
    a, at = folded(text)
    found: dict[tuple[int, int], tuple[int, int]] = {}
    exact: dict[int, list[int]] = {}
    overlap, bound = 3 * index.longest + index.q, word_bounds(a)
    for s in range(0, max(1, len(a) - overlap), BLOCK):
        part = a[s:s + BLOCK + overlap]
        if len(part) < index.q:
            break
        for i, low, high in index.candidates(part):
            item, k = index.texts[i], int(index.budget[i])
            x = max(0, low - k)
            there = exact.setdefault(i, [])
            j = bisect_left(there, low + s)
            if j < len(there) and there[j] <= high + s:
                continue  # nothing is nearer than what is there
            region = part[x:high + 2 * k + len(item) + 1]
            ends = bound[x + s:x + s + len(region) + 1]
            same = region.tobytes().find(item.tobytes())
            if same >= 0 and same % 4 == 0 and ends[same // 4] and ends[same // 4 + len(item)]:
                hit = (0, same // 4, same // 4 + len(item))
                insort(there, hit[1] + x + s)
            else:
                hit = align(item, region, low - x, high - x, k, ends)
            if hit and hit[2] > hit[1]:
                edits, start, end = hit[0], hit[1] + x + s, hit[2] + x + s
                if edits < found.get((i, start), (k + 1, 0))[0]:
                    found[i, start] = (edits, end)
    out, taken = [], {}
    for (i, start), (edits, end) in sorted(found.items(), key=lambda x: (x[0][0], x[1][0], x[0][1])):
        of = taken.setdefault(i, [])
        j = bisect_left(of, (start, end))
        if (j == 0 or of[j - 1][1] <= start) and (j == len(of) or of[j][0] >= end):
            of.insert(j, (start, end))
            out.append({"item_id": index.ids[i], "start": int(at[start]), "end": int(at[end - 1]) + 1, "edits": edits,
                        "similarity": 1 - edits / len(index.texts[i])})
    for i, start, end in short_places(a, index, bound):
        out.append({"item_id": i, "start": int(at[start]), "end": int(at[end - 1]) + 1, "edits": 0, "similarity": 1.0})
    return sorted(out, key=lambda x: (x["start"], x["item_id"]))


def _found(text: Column, sent) -> Column:
    @F.arrow_udf(HITS)
    def hits(texts: pa.Array) -> pa.Array:
        return pa.array([find(t, sent.value) for t in texts.to_pylist()], pa.list_(HIT))

    return hits(text)


def _indexes(benchmark: DataFrame, item_id: str, item: str, q: int, error: float, least: int, block_chars: int):
    """(number of blocks, index of a block) one block after another."""
    items = benchmark.select(quoted(item_id).try_cast("long").alias("i"), quoted(item).alias("t")).dropna()
    chars = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = 1 + chars // block_chars
    for b in range(blocks):
        of = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        yield blocks, Index([(r.i, r.t) for r in of], q, error, least)


def _each_block(benchmark: DataFrame, rows, **how) -> DataFrame:
    """Union of ``rows(sent index)``.  Of several blocks one at a time is sent, and taken back when its rows are written."""
    context, parts = benchmark.sparkSession.sparkContext, []
    for blocks, index in _indexes(benchmark, **how):
        sent = context.broadcast(index)
        if blocks == 1:
            return rows(sent)
        parts.append(staged(rows(sent), "hits"))
        sent.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item: str = "text", q: int = 8, error: float = 0.1, least: int = 1, block_chars: int = 4_000_000) -> DataFrame:
    """``doc_id, item_id, start, end, edits, similarity``: a row for each place of an item in a document.

    An item of ``m`` folded characters is found where a region of the text that
    begins and ends at word bounds is within ``error * m`` edits (fewer where
    the q-gram bound would fall below one); an item of fewer than ``q`` as it
    is.  Items of fewer than ``least`` folded characters are left out, as are
    null texts, items without letters and digits, and items whose id is null or
    no whole number.

    The benchmark is taken in blocks of about ``block_chars`` characters (some
    30 bytes of index each), one after another; places of an item don't
    overlap.  Null and empty texts hold nothing.  Repeated rows are each
    reported; empty tables give no rows; other columns aren't read.
    """
    def rows(sent) -> DataFrame:
        return docs.select(quoted(doc_id).alias("doc_id"), _found(quoted(text), sent).alias("hits")).select("doc_id", F.inline("hits"))

    return _each_block(benchmark, rows, item_id=item_id, item=item, q=q, error=error, least=least, block_chars=block_chars)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item: str = "text",
                  q: int = 8, error: float = 0.1, least: int = 1, block_chars: int = 4_000_000) -> DataFrame:
    """The documents that hold no benchmark item (as ``contaminated`` finds them), with all their columns as they are.

    With one block documents are filtered as they are read; with several, the
    digests of the texts that hold an item are written block by block.
    """
    t = F.coalesce(quoted(text), F.lit(""))
    key = [F.xxhash64(t).alias("k1"), F.xxhash64(t, F.lit(1)).alias("k2")]
    row, one = F.struct(*[quoted(c) for c in docs.columns]).alias("row"), []

    def rows(sent) -> DataFrame:
        one.append(docs.select(row, _found(quoted(text), sent).alias("hits")).filter(F.size("hits") == 0).select("row.*"))
        return docs.select(*key, _found(quoted(text), sent).alias("hits")).filter(F.size("hits") > 0).select("k1", "k2")

    found = _each_block(benchmark, rows, item_id=item_id, item=item, q=q, error=error, least=least, block_chars=block_chars)
    if len(one) == 1:
        return one[0]
    return docs.select(row, *key).join(found.distinct(), ["k1", "k2"], "left_anti").select("row.*")
