"""Passages of held-out evaluation items inside corpus texts.

A passage of 20 words with at most one word in ten changed holds six successive words unchanged, wherever the changes
fall, and with them four words that begin at a multiple of three in the item. Those are the patterns of an Aho-Corasick
automaton over words; each text is read and cut into words once. Around the hits the alignment of text and item is
extended in both directions by furthest-reaching diagonals until the share of edits is exceeded, and the words' offsets
give the place in the original text.

The automaton is built once, in a Spark job, and goes to the tasks as it was built. A test set too large for one is built as several
parts, which a task applies one after another to the texts it has read, so that its memory is that of one part and the
corpus is still read once.
"""

from __future__ import annotations

import html
import pickle
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.session import kept

#: Least words of a passage, words per edit allowed, and the unchanged words that this guarantees.
MIN_WORDS, WORDS_PER_EDIT, ANCHOR = 20, 10, 6
#: Words of a pattern, and the step between patterns: any ANCHOR words of an item in a row hold one.
GRAM, STEP = 4, 3
#: Anchors that any passage has, and the words and diagonals they can lie apart.
ANCHORS, SLACK, DRIFT = MIN_WORDS - (ANCHOR - 1) - ANCHOR * (MIN_WORDS // WORDS_PER_EDIT), MIN_WORDS + 4, MIN_WORDS // WORDS_PER_EDIT
#: Words that must match outside the outermost edits: a passage begins and ends with words of the item.
FLANK = 1
#: Letters of the automaton's alphabet for each place of a word.
BASE = 128
#: Words of the items in one part of the automaton, on average, and characters of text that a task holds for several parts.
PART_WORDS, CHUNK_CHARS = 250_000, 64_000_000

#: Tags, comments and declarations of mark-up, of any length. A lone "<" is a character like any other.
_TAG = re.compile(
    r"""<!--.*?-->|<[!?][A-Za-z][^<>]*>|</?[A-Za-z][\w:-]*(?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>=]+))*\s*/?>""", re.S
)
_GAP = re.compile(r"[\s–—]+")
_DROP = re.compile(r"[^\w\s]|_")
_TOKEN = re.compile(r"[^\s–—]+")
_BROKEN = re.compile(r"(?<=\w)[-\u00ad]\s*\n\s*(?=\w)")


def placed_words(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) with offsets into ``text``: no case, no punctuation, no mark-up; broken words are joined."""
    t = _TAG.sub(lambda m: " " * len(m.group()), text) if "<" in text else text
    joins = {m.end() for m in _BROKEN.finditer(t)} if "-\n" in t or "\u00ad" in t or "- " in t else set()
    out: list[tuple[str, int, int]] = []
    for m in _TOKEN.finditer(t):
        token, start, end = m.group(), m.start(), m.end()
        glue = start in joins and bool(out)
        for part in _GAP.split(html.unescape(token)) if "&" in token else (token,):
            if w := _DROP.sub("", part.casefold()):
                if glue:
                    out[-1] = (out[-1][0] + w, out[-1][1], end)
                    glue = False
                else:
                    out.append((w, start, end))
    return out


def words(text: str) -> list[str]:
    """The words of ``placed_words``, at once where a text has neither entities nor broken words."""
    if "&" in text or _BROKEN.search(text) or ("<" in text and _BROKEN.search(_TAG.sub(" ", text))):
        return [w for w, _, _ in placed_words(text)]
    t = _TAG.sub(" ", text) if "<" in text else text
    return _DROP.sub("", t.casefold().replace("–", " ").replace("—", " ")).split()


class LeakFinder:
    """Automaton and item words of one part of the items."""

    def __init__(self, items: Sequence[tuple[int, str]]):
        import ahocorasick

        texts = [(i, words(t)) for i, t in items if t]
        self.ids = [i for i, _ in texts]
        vocabulary = sorted({w for _, ws in texts for w in ws})
        if len(vocabulary) > 0x10FFFF - 0x10000:
            raise ValueError("more different words in one part of the items than an automaton has symbols")
        # one symbol per word, above the ASCII range; words no item has share a symbol that is in no pattern
        self.symbol = {w: chr(0x100 + n if n < 0xD000 else 0x10000 + n - 0xD000) for n, w in enumerate(vocabulary)}
        self.items = ["".join(self.symbol[w] for w in ws) for _, ws in texts]
        # a node of the automaton looks through its children one by one, so it gets a word as letters of a small alphabet, an
        # alphabet of its own for each place; the first place's can't match within a word
        self.width = 1
        while BASE**self.width < len(vocabulary):
            self.width += 1
        self.spelled = {w: "".join(chr(0x100 + BASE * k + n // BASE**k % BASE) for k in range(self.width)) for n, w in enumerate(vocabulary)}
        self.known = re.compile("[^\x01]{%d,}" % (ANCHOR * self.width))
        places = defaultdict(list)
        for i, (_, ws) in enumerate(texts):
            spelled = [self.spelled[w] for w in ws]
            for p in range(0, len(ws) - GRAM + 1, STEP):
                places["".join(spelled[p : p + GRAM])].append((i, p))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, pattern in enumerate(places):
            self.automaton.add_word(pattern, n)
        if places:
            self.automaton.make_automaton()
        # where each pattern stands, pattern after pattern
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in places.values()])]).astype(np.int64)
        self.places = np.array([x for at in places.values() for x in at], dtype=np.int32).reshape(-1, 2)

    def find(self, text: str, known: list[str] | None = None) -> list[tuple[int, int, int, int, int]]:
        """(item, words, edits, start, end) of every passage that the text leaks; passages of an item don't lie in each other."""
        if not len(self.places) or not text:
            return []
        ws = words(text) if known is None else known
        if len(ws) < MIN_WORDS - MIN_WORDS // WORDS_PER_EDIT:
            return []
        get, none, width = self.spelled.get, "\x01" * self.width, self.width
        ends, ids = [], []
        # a pattern only lies where six words in a row are words of items
        for run in self.known.finditer("".join([get(w, none) for w in ws])):
            start = run.start()
            for end, n in self.automaton.iter(run.group()):
                ends.append((start + end) // width)
                ids.append(n)
        if not ends:
            return []
        codes = "".join([self.symbol.get(w, "\x01") for w in ws])
        out, placed = [], None
        for item, runs in self._runs(codes, np.array(ends), np.array(ids)):
            covered: list[tuple[int, int]] = []
            for d, last, p in runs:
                # what lies within a passage found before adds nothing
                if any(first <= d and last <= end for first, end in covered):
                    continue
                if found := self._extend(codes, self.items[item], d, p):
                    n, edits, first, end = found
                    covered.append((first, end))
                    placed = placed or placed_words(text)
                    out.append((self.ids[item], n, -edits, placed[first][1], placed[end][2]))
        return sorted(set(out))

    def _runs(self, codes: str, ends: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Unchanged runs that can be part of a passage, by item: (first word in the text, last word, first word in the item).

        A passage with e edits holds a part of MIN_WORDS words with a tenth of edits, in which ANCHORS anchors at least,
        six unchanged words each, lie within SLACK words and DRIFT diagonals of each other.
        """
        n = self.starts[ids + 1] - self.starts[ids]
        place = self.places[np.repeat(self.starts[ids] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        d = np.repeat(ends - GRAM + 1, n)
        item, p = place[:, 0], place[:, 1]
        order = np.lexsort((d, d - p, item))
        found: dict[int, list[tuple[int, int, int]]] = {}
        last = (-1, 0, -1)  # item, diagonal, last word of the run before
        for i, f, q in zip(item[order].tolist(), d[order].tolist(), p[order].tolist()):
            if last[0] == i and last[1] == f - q and f <= last[2]:
                continue
            words_of, diagonal, end = self.items[i], f - q, f + GRAM
            while end < len(codes) and end - diagonal < len(words_of) and codes[end] == words_of[end - diagonal]:
                end += 1
            while f and q and codes[f - 1] == words_of[q - 1]:
                f, q = f - 1, q - 1
            last = (i, diagonal, end - 1)
            if end - f >= ANCHOR:
                found.setdefault(i, []).append((f, end - f - ANCHOR + 1, q))
        for i, mine in found.items():
            if sum(count for _, count, _ in mine) < ANCHORS:
                continue
            first, count, at = zip(*mine)
            by_diagonal: dict[int, tuple[list[int], list[int]]] = {}
            for f, c, q in zip(first, count, at):
                begins, lasts = by_diagonal.setdefault(f - q, ([], []))
                begins.append(f)
                lasts.append(f + c - 1)
            runs = []
            for f, c, q in zip(first, count, at):
                low, high, near = f - SLACK, f + c - 1 + SLACK, 0
                for diagonal in range(f - q - DRIFT, f - q + DRIFT + 1):
                    if (x := by_diagonal.get(diagonal)) is not None:
                        begins, lasts = x
                        for k in range(bisect_left(lasts, low), bisect_right(begins, high)):
                            near += min(lasts[k], high) - max(begins[k], low) + 1
                            if near >= ANCHORS:
                                break
                    if near >= ANCHORS:
                        runs.append((f, f + c + ANCHOR - 2, q))
                        break
            if runs:
                yield i, sorted(runs, key=lambda r: (r[0] - r[1], r))

    @staticmethod
    def _reach(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
        """reach[e] = (words of a, words of b) matched furthest with e edits, ending in matched words."""
        na, nb = len(a), len(b)
        frontier, reach, e = {0: 0}, [(0, 0)], 0
        while True:
            best, after = reach[-1], {}
            for k, i in frontier.items():
                s = i
                while i < na and i + k < nb and a[i] == b[i + k]:
                    i += 1
                after[k] = i
                if i - s >= FLANK and i > best[0]:
                    best = (i, i + k)
            reach[-1] = best
            # a passage can always be cut where more edits than its share, and two, are used up
            if best[0] < WORDS_PER_EDIT * (e - 1) or best[0] >= na:
                return reach
            frontier = {}
            for k, i in after.items():
                for k2, i2 in ((k, i + 1), (k - 1, i + 1), (k + 1, i)):
                    if i2 <= na and 0 <= i2 + k2 <= nb and frontier.get(k2, -1) < i2:
                        frontier[k2] = i2
            e += 1
            if not frontier or e > na:
                return reach
            reach.append(best)

    def _extend(self, ws: str, item: str, d: int, p: int) -> tuple[int, int, int, int] | None:
        span = len(item) + len(item) // 5 + 5
        right = self._reach(item[p:], ws[d : d + span])
        left = self._reach(item[:p][::-1], ws[max(0, d - span) : d][::-1])
        best = None
        for el, (il, dl) in enumerate(left):
            for er, (ir, dr) in enumerate(right):
                n, e = il + ir, el + er
                if n >= max(MIN_WORDS, WORDS_PER_EDIT * e) and (best is None or (n, -e) > best[:2]):
                    best = (n, -e, d - dl, d + dr - 1)
        return best


def build_parts(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """The automaton as built, one row per part: part, built. Items are spread over the parts by their ids, on the executors."""
    chosen = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL AND trim(t) <> ''")
    size = chosen.agg(F.coalesce(F.sum(F.size(F.split("t", r"\s+"))), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_WORDS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        finder = LeakFinder(list(zip(rows.i.tolist(), rows.t)))
        return pd.DataFrame({"part": [int(rows.part.iloc[0])], "built": [pickle.dumps(finder.__dict__, 5)]})

    return chosen.withColumn("part", F.pmod(F.xxhash64("i"), F.lit(parts)).cast("int")).groupBy("part").applyInPandas(build, "part int, built binary")


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Leaked passages: doc_id, item_id, n_words, n_edits, start_char, end_char, every one of each pair.

    Null and empty texts leak nothing, equal items are reported each, repeated documents once per row. Items with fewer
    words than a passage needs are never found. The driver passes on one part of the automaton at a time.
    """
    spark = documents.sparkSession
    built = kept(build_parts(items, item_id, text), "automaton")
    sent = [spark.sparkContext.broadcast(bytes(row.built)) for row in built.toLocalIterator()]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "item_id", "n_words", "n_edits", "start_char", "end_char"]

        def load(part) -> LeakFinder:
            finder = LeakFinder.__new__(LeakFinder)
            finder.__dict__.update(pickle.loads(part.value))
            part.__dict__.pop("_value", None)  # else the worker would keep every part
            return finder

        if len(sent) <= 1:
            finders = [load(part) for part in sent]
            for b in batches:
                yield pd.DataFrame([(d, *found) for f in finders for d, t in zip(b.doc_id, b.text) for found in f.find(t)], columns=columns)
            return

        def chunks() -> Iterator[list[tuple[int, str]]]:
            chunk, chars = [], 0
            for b in batches:
                chunk += zip(b.doc_id, b.text)
                chars += int(b.text.str.len().sum())
                if chars >= CHUNK_CHARS:
                    yield chunk
                    chunk, chars = [], 0
            yield chunk

        for chunk in chunks():
            cut_up = [(d, t, words(t)) for d, t in chunk]
            for part in sent:
                finder = load(part)
                yield pd.DataFrame([(d, *found) for d, t, ws in cut_up for found in finder.find(t, ws)], columns=columns)

    corpus = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    return corpus.mapInPandas(scan, "doc_id long, item_id long, n_words int, n_edits int, start_char int, end_char int")
