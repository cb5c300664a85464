"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised alike: words (``\\w+``), lower-cased, joined
by single spaces, with a space at both ends.  An item of m characters may occur
with up to k = floor(m * ERROR_RATE) edits.  It is split into k + 1 pieces; k
edits leave at least one piece untouched, so every occurrence contains an exact
piece at most k characters from its place.  One Aho-Corasick automaton over the
pieces of all items finds those hits in a single pass over a text.

Myers' bit-parallel algorithm verifies hits in a tree over the pieces: a block of
p adjacent pieces has a budget of p - 1 edits.  If a block is within its budget,
one of its halves is within its own, so an occurrence always shows a piece from
which every block up to the whole item can be verified in turn, and a chance hit
is usually refused at the smallest block.  The whole item's distance is then
computed in the surviving windows (overlapping ones of one item as one).

Documents are only scanned, never shuffled.  Items reach the tasks in blocks of
about ``BLOCK_CHARS`` characters (one block unless the benchmark is larger), so
what is broadcast is bounded by that parameter; each block is one pass.

Defined cases: null and empty texts match nothing, items without a word match
nothing; repeated rows and repeated items each get their matches; of several
occurrences the one of least distance, then the first, is reported; empty tables
give an empty result; extra columns don't matter.
"""

from __future__ import annotations

import bisect
import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.1
BLOCK_CHARS = 8_000_000

_WORD = re.compile(r"\w+")


def normalise(text: str | None) -> str:
    """Lower-cased words between single spaces; empty without a word."""
    words = _WORD.findall(text or "")
    return f" {' '.join(words).lower()} " if words else ""


def budget(m: int, rate: float = ERROR_RATE) -> int:
    return int(m * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces of nearly equal length that cover the item."""
    m = len(item)
    cuts = [m * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def blocks_above(parts: list[tuple[int, str]]) -> list[list[tuple[int, int, int]]]:
    """For each piece the blocks (start, end, budget) from its parent up to the whole item."""
    above: list[list[tuple[int, int, int]]] = [[] for _ in parts]

    def split(a: int, b: int) -> None:
        if b - a < 2:
            return
        mid = (a + b) // 2
        split(a, mid)
        split(mid, b)
        for i in range(a, b):
            above[i].append((parts[a][0], parts[b - 1][0] + len(parts[b - 1][1]), b - a - 1))

    split(0, len(parts))
    return above


def halves_beside(item: str, parts: list[tuple[int, str]], offset: int, above: list[tuple[int, int, int]]) -> list[str]:
    """Halves of the other pieces in a piece's smallest block.

    A block of p pieces has at most p - 1 edits; if one piece is whole, the edits
    hit at most p - 1 of the other pieces' 2p - 2 halves, so a half is found too.
    """
    if not above:
        return []
    a, b, _ = above[0]
    out = []
    for at, piece in parts:
        if a <= at < b and at != offset:
            mid = len(piece) // 2
            out += [piece[:mid], piece[mid:]]
    return out


def masks(item: str) -> dict[str, int]:
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        peq[c] |= 1 << i
    return dict(peq)


def myers(peq: dict[str, int], m: int, text: str, anchored: bool = False) -> Iterator[int]:
    """Edit distance of the pattern to the best substring that ends at each position of ``text``.

    ``anchored``: to the whole prefix instead of the best substring.
    """
    full, last, first = (1 << m) - 1, 1 << (m - 1), int(anchored)
    up, down, score = full, 0, m
    for c in text:
        eq = peq.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus = down | (~(across | up) & full)
        minus = up & across
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus = ((plus << 1) | first) & full
        minus = (minus << 1) & full
        up = minus | (~(vertical | plus) & full)
        down = plus & vertical
        yield score


class Matcher:
    """The automaton and bit masks of one block of items [(item_id, text)]."""

    def __init__(self, items: list[tuple], rate: float = ERROR_RATE):
        self.items = []
        self.block_masks: dict[tuple[int, int, int], dict[str, int]] = {}
        found: dict[str, list[tuple]] = defaultdict(list)
        for item_id, text in items:
            norm = normalise(text)
            if not norm:
                continue
            k = budget(len(norm), rate)
            parts = pieces(norm, k)
            for (offset, piece), above in zip(parts, blocks_above(parts)):
                found[piece].append((len(self.items), offset, above, halves_beside(norm, parts, offset, above)))
            self.items.append((item_id, norm, k, masks(norm), masks(norm[::-1])))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if self.items:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Windows of the normalised text to verify, by item: merged where they overlap."""
        out: dict[int, list[list[int]]] = {}
        if not self.items:
            return out
        for end, (size, places) in self.automaton.iter(text):
            for i, offset, above, halves in places:
                _, norm, k, _, _ = self.items[i]
                start = end + 1 - size - offset
                lo, hi = max(0, start - k), min(len(text), start + len(norm) + k)
                spans = out.get(i)
                if spans and any(a <= lo and hi <= b for a, b in reversed(spans[-4:])):
                    continue  # another piece has led to this window
                if above:
                    a, b, errors = above[0]
                    near = text[max(0, start + a - errors):start + b + errors]
                    if not any(h in near for h in halves):
                        continue
                if all(self.within(i, text, start, *block) for block in above):
                    out.setdefault(i, []).append([lo, hi])
        for spans in out.values():
            spans.sort()
            merged = [spans[0]]
            for lo, hi in spans[1:]:
                if lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
            spans[:] = merged
        return out

    def within(self, i: int, text: str, start: int, a: int, b: int, errors: int) -> bool:
        """Whether item[a:b] occurs with at most ``errors`` edits where an item that begins at ``start`` would have it."""
        key = (i, a, b)
        peq = self.block_masks.get(key)
        if peq is None:
            peq = self.block_masks[key] = masks(self.items[i][1][a:b])
        part = text[max(0, start + a - errors):start + b + errors]
        return any(score <= errors for score in myers(peq, b - a, part))

    def match(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, start, end) of each item's best occurrence in a normalised text."""
        found = []
        for i, spans in self.windows(text).items():
            _, norm, k, peq, back = self.items[i]
            best = None
            for lo, hi in spans:
                part = text[lo:hi]
                if (at := part.find(norm)) >= 0:
                    case = (0, lo + at, lo + at + len(norm))
                else:
                    least, end = min(((d, e) for e, d in enumerate(myers(peq, len(norm), part))), default=(k + 1, 0))
                    if least > k:
                        continue
                    before = part[max(0, end + 1 - len(norm) - k):end + 1][::-1]
                    _, length = min((d, n) for n, d in enumerate(myers(back, len(norm), before, anchored=True), 1))
                    case = (least, lo + end + 1 - length, lo + end + 1)
                best = min(best or case, case)
            if best:
                found.append((i, *best))
        return sorted(found)


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Code points in the original text of the words that a span of the normalised text touches."""
    words = list(_WORD.finditer(text))
    at, begins = 1, []
    for w in words:
        begins.append(at)
        at += len(w.group().lower()) + 1
    first = max(0, bisect.bisect_right(begins, start) - 1)
    if start >= begins[first] + len(words[first].group().lower()) and first + 1 < len(words):
        first += 1
    last = max(first, bisect.bisect_left(begins, end) - 1)
    return words[first].start(), words[last].end()


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The benchmark as lists [(item_id, text)] of about ``block_chars`` characters each."""
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield sorted(((r["item_id"], r["text"]) for r in part.select("item_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


_MATCHERS: dict[tuple, Matcher] = {}


def matcher_of(shared, rate: float) -> Matcher:
    """One matcher for each block and Python worker."""
    key = (shared.value[0], rate)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(shared.value[1], rate)
    return _MATCHERS[key]


def _share(docs: DataFrame, block: list[tuple]):
    import uuid

    return docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block))


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, distance, start_char, end_char (end exclusive)."""
    source = docs.select("doc_id", "text")
    schema = source.select("doc_id").schema
    schema = schema.add(items.schema["item_id"]).add("distance", "long").add("start_char", "long").add("end_char", "long")
    result = None
    for block in item_blocks(items):
        shared = _share(docs, block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = matcher_of(shared, rate)
            for b in batches:
                rows, cols = [], ([], [], [], [])
                texts = b.column("text")
                for r in range(b.num_rows):
                    text = texts[r].as_py() or ""
                    for i, distance, lo, hi in m.match(normalise(text)):
                        start, end = original_span(text, lo, hi)
                        rows.append(r)
                        for c, v in zip(cols, (m.items[i][0], distance, start, end)):
                            c.append(v)
                ids = b.column("doc_id").take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(cols[0], id_type), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                                 ["doc_id", "item_id", "distance", "start_char", "end_char"])

        id_type = arrow_type(items, "item_id")
        part = source.mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return result


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def drop_leaks(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, with all their columns; nothing is shuffled."""
    out = docs
    for block in item_blocks(items):
        shared = _share(docs, block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = matcher_of(shared, rate)
            for b in batches:
                texts = b.column("text")
                clean = [not m.match(normalise(texts[r].as_py())) for r in range(b.num_rows)]
                yield b.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
