"""Text decoded with the wrong character encoding: finding it and restoring the original.

Three steps. (1) One pass counts adjacent character pairs with a character beyond ASCII over the whole corpus. Runs that
by their structure are UTF-8 read wrongly aren't counted, so frequent garbling doesn't become ordinary. (2) In
each text, a pair is scored by its mutual information, normalised by the information of the pair: neighbours that
hold less of each other than ordinary text does score high; maximum-scoring segments isolate the improbable runs. (3) Only inside those,
inverse mappings are tried: encode with the encoding that was wrongly used, decode with the right one. A mapping holds where
the restored characters are, by the same pair statistics, clearly likelier neighbours than those that stand there.
Replacement characters mark passages that cannot be restored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings that text was wrongly read with, and those it was written in.
WRONG = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "cp1250", "iso8859-2", "koi8-r", "cp1254")
RIGHT = ("utf-8", "cp1252", "cp1250", "iso8859-2", "mac_roman", "cp850")

#: Neighbours of this mutual information are ordinary, less makes a run improbable; weight of a pair, and what a pair of ASCII
#: characters takes from a segment.
ORDINARY, PAIR_BITS, ASCII_BITS = 0.6, 10.0, 1.5
#: Bits a mapping must gain in a segment: multi-byte sequences prove much by being valid, single bytes nothing.
GAIN_UTF8, GAIN_SINGLE = 4.0, 8.5
#: Bits that speak against text having been written in an encoding, beside the two usual ones.
UNUSUAL = {"cp1250": 6.0, "iso8859-2": 6.0, "mac_roman": 6.0, "cp850": 6.0}
#: Pairs sent to every task at most. Their number follows from the alphabets of a corpus, not from its size.
MOST_PAIRS = 3_000_000

REPLACED = "�"
_RUN = re.compile(r"[^\x00-\x7f]+")
_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")


def single_byte_table(encoding: str) -> list[str]:
    """The 256 characters of an encoding; an undefined byte stands for the control character of its number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


TABLES = {e: single_byte_table(e) for e in {*WRONG, *RIGHT} - {"utf-8"}}
BYTES = {e: {c: b for b, c in reversed(list(enumerate(TABLES[e]))) if b >= 128} for e in WRONG}


def _utf8_sequences(encoding: str) -> re.Pattern:
    """Multi-byte UTF-8 sequences as they look when read with a single-byte encoding."""
    chars = lambda lo, hi: "[" + "".join(re.escape(TABLES[encoding][b]) for b in range(lo, hi + 1)) + "]"
    tail = chars(0x80, 0xBF)
    return re.compile(f"{chars(0xC2, 0xDF)}{tail}|{chars(0xE0, 0xEF)}{tail}{{2}}|{chars(0xF0, 0xF4)}{tail}{{3}}")


SEQUENCES = {e: _utf8_sequences(e) for e in WRONG}
#: Characters that a wrong reading can produce.
REPERTOIRE = frozenset(c for e in WRONG for c in TABLES[e][128:]) | {REPLACED}


def remap(run: str, wrong: str, right: str) -> str | None:
    """``run`` as it would have been; None where the mapping doesn't apply."""
    table = BYTES[wrong]
    if right == "utf-8":
        changed = False

        def decode(m: re.Match) -> str:
            nonlocal changed
            try:
                text = bytes(table[c] for c in m.group()).decode("utf-8")
            except (UnicodeDecodeError, KeyError):
                return m.group()
            changed = True
            return text

        out = SEQUENCES[wrong].sub(decode, run)
        return out if changed else None
    into = TABLES[right]
    out = "".join(into[table[c]] if c in table else c for c in run)
    return out if out != run and not any("\x80" <= c <= "\x9f" for c in out) else None


MAPPINGS = [(w, r) for r in RIGHT for w in WRONG if w != r]


#: Characters that in text, too, may follow those that stand for Latin letters; one run with them proves nothing, two different ones do.
AMBIGUOUS = {"mac_roman": set("πµΩ∂∑∫∞"), "cp1251": set("«»–—…“”„‘’№ёЁ·•§\xa0"), "koi8-r": set("ёЁ")}
_SEVERAL = re.compile(r"[^\x00-\x7f]{2,}")


def _telling(encoding: str) -> re.Pattern:
    """Sequences of Latin letters and usual punctuation, or three of any kind in a row."""
    t = [re.escape(c) for c in TABLES[encoding]]
    chars = lambda lo, hi: "[" + "".join(t[lo : hi + 1]) + "]"
    latin = f"{t[0xC2]}{chars(0xA0, 0xBF)}|{t[0xC3]}{chars(0x80, 0xBF)}"
    usual = f"{t[0xE2]}(?:{t[0x80]}{chars(0x90, 0xBF)}|{t[0x82]}{t[0xAC]}|{t[0x84]}{t[0xA2]})"
    return re.compile(f"(?:{latin}|{usual})+|(?:{SEQUENCES[encoding].pattern}){{3,}}")


TELLING = {e: _telling(e) for e in WRONG}
WHOLE = {e: re.compile(f"(?:{SEQUENCES[e].pattern})+") for e in WRONG}


def _readings(run: str) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """Encodings in which a run is UTF-8 from end to end; of these, those it proves and those it proves with another run."""
    whole = [e for e in WRONG if WHOLE[e].fullmatch(run)]
    told = [e for e in whole if TELLING[e].fullmatch(run)]
    weak = tuple(e for e in told if len(run) == 2 and run[1] in AMBIGUOUS.get(e, ()))
    return tuple(whole), tuple(e for e in told if e not in weak), weak


def without_misread(text: str, known: dict) -> str:
    """``text`` without the runs that by their structure are UTF-8 read wrongly. ``known`` keeps the readings of runs."""
    runs = set(_SEVERAL.findall(text))
    if not runs:
        return text
    if len(known) > 500_000:  # only a cache
        known.clear()
    proven, weak = set(), []
    for r in runs:
        if r not in known:
            known[r] = _readings(r)
        proven.update(known[r][1])
        weak += known[r][2]
    proven.update(e for e in weak if weak.count(e) > 1)
    if not proven:
        return text
    return _SEVERAL.sub(lambda m: m.group() if proven.isdisjoint(known[m.group()][0]) else "", text)


def count_pairs(documents: DataFrame, text: str = "text") -> DataFrame:
    """Corpus counts: a, b (code points), n. b is -1 in the counts of single characters, a and b are -1 in the total.

    Pairs have at least one character beyond ASCII. Counting is vectorised per Arrow batch and summed in Spark. Runs that
    are wrongly read UTF-8 by their structure are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs: dict[int, int] = {}
        singles = np.zeros(0x110000, dtype=np.int64)
        known: dict = {}
        for b in batches:
            for t in np.array_split(b.text.dropna().to_numpy(), max(1, len(b) // 200)):
                codes = np.frombuffer("\n".join(x if x.isascii() else without_misread(x, known) for x in t).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                if not len(codes):
                    continue
                singles += np.bincount(codes, minlength=0x110000) if len(codes) > 200_000 else 0
                if len(codes) <= 200_000:
                    at, n = np.unique(codes, return_counts=True)
                    singles[at] += n
                beyond = codes > 127
                mask = beyond[:-1] | beyond[1:]
                key, n = np.unique((codes[:-1][mask].astype(np.int64) << 21) | codes[1:][mask], return_counts=True)
                for k, m in zip(key.tolist(), n.tolist()):
                    pairs[k] = pairs.get(k, 0) + m
        at = np.flatnonzero(singles)
        rows = [(k >> 21, k & 0x1FFFFF, n) for k, n in pairs.items()] + [(int(a), -1, int(singles[a])) for a in at]
        yield pd.DataFrame(rows, columns=["a", "b", "n"])

    return documents.select(F.col(text).alias("text")).mapInPandas(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


class PairModel:
    """Pair probabilities from corpus counts."""

    def __init__(self, counts: list[tuple[int, int, int]]):
        self.single = {chr(a): n for a, b, n in counts if b < 0}
        self.pair = {chr(a) + chr(b): n for a, b, n in counts if b >= 0}
        self.total = max(1, sum(self.single.values()))

    def mutual(self, a: str, b: str) -> float:
        """Mutual information of two neighbours, log2 p(a, b) / (p(a) p(b)), in units of -log2 p(a, b): -1 to 1.

        Pairs are smoothed by what independence lets expect, so neighbours that never meet have none.
        """
        single = (self.single.get(a, 0) + 0.5) * (self.single.get(b, 0) + 0.5) / self.total
        joint = self.pair.get(a + b, 0) + single
        information = log2(self.total / joint)
        return log2(joint / single) / information if information > 0 else 1.0

    def follows(self, a: str, b: str) -> float:
        """log2 p(b | a), smoothed with the frequency of b."""
        if a < "\x80" and b < "\x80":
            return 0.0
        prior = (self.single.get(b, 0) + 0.1) / self.total
        return log2((self.pair.get(a + b, 0) + prior) / (self.single.get(a, 0) + 1))

    def likelihood(self, text: str) -> float:
        return sum(map(self.follows, text, text[1:]))


class Zone:
    """What is known of a run of characters beyond ASCII between its two neighbours."""

    __slots__ = ("score", "gains", "hopeful")

    def __init__(self, model: PairModel, whole: str):
        run = whole[1:-1]
        self.score = sum(PAIR_BITS * (ORDINARY - model.mutual(a, b)) for a, b in zip(whole, whole[1:]))
        self.gains: dict[tuple[str, str], tuple[float, str]] = {}
        if self.score > 0:
            here = model.likelihood(whole)
            for mapping in MAPPINGS:
                restored = remap(run, *mapping)
                if restored is not None:
                    # likelihoods of two readings of the same bytes
                    self.gains[mapping] = (model.likelihood(whole[0] + restored + whole[-1]) - here, restored)
        self.hopeful = any(gain >= 1 for gain, _ in self.gains.values())


def segments(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring segments of a sequence, as half-open ranges, in linear time."""
    # entries: start, end, sum before the segment, sum up to its end, last entry whose sum before is lower
    stack: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, low, j = i, before, len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                break
            start, _, low, _, lower = stack[j]
            del stack[j:]
            j = lower
        stack.append((start, i + 1, low, total, j))
    return [(x[0], x[1]) for x in stack]


class Repairer:
    """Finds and restores wrongly decoded passages by a pair model."""

    def __init__(self, model: PairModel):
        self.model, self.zones = model, {}

    def _zones(self, text: str) -> list[tuple[int, int, Zone]]:
        known, out, end = self.zones, [], len(text)
        if len(known) > 500_000:  # only a cache
            known.clear()
        for m in _RUN.finditer(text):
            a, b = m.span()
            key = text[a - 1 : b + 1] if a and b < end else (text[a - 1] if a else "\n") + m.group() + (text[b] if b < end else "\n")
            zone = known.get(key)
            if zone is None:
                zone = known[key] = Zone(self.model, key)
            out.append((a, b, zone))
        return out

    def _once(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, restored) of the runs to replace."""
        found = self._zones(text)
        if not any(z.hopeful for _, _, z in found):
            return []
        scores, last = [], None
        for a, b, zone in found:
            if last is not None:
                scores.append(-ASCII_BITS * max(0, a - last - 2))
            scores.append(zone.score)
            last = b
        parts, proven = [], set()
        for i, j in segments(scores):
            inside = found[(i + 1) // 2 : (j + 1) // 2]
            if not any(z.hopeful for _, _, z in inside):
                continue
            total: dict[tuple[str, str], float] = {}
            for _, _, z in inside:
                for mapping, (gain, _) in z.gains.items():
                    # a single-byte reading holds for every character of a passage, so losses count too
                    if gain > 0 or mapping[1] != "utf-8":
                            total[mapping] = total.get(mapping, -UNUSUAL.get(mapping[1], 0.0)) + gain
            parts.append((inside, total))
            held = [(g, m) for m, g in total.items() if g >= (GAIN_UTF8 if m[1] == "utf-8" else GAIN_SINGLE)]
            if held:
                proven.add(max(held)[1])
        out = []
        for inside, total in parts:
            # a mapping proven in one passage needs less proof in the others of the same text
            held = [(g, m) for m, g in total.items() if g >= (GAIN_UTF8 if m[1] == "utf-8" else GAIN_SINGLE) or m in proven and g >= 1]
            if held:
                best = max(held)[1]
                out += [(a, b, z.gains[best][1]) for a, b, z in inside if best in z.gains and (z.gains[best][0] > 0 or best[1] != "utf-8")]
        return out

    def _pieces(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, restored) of the runs to replace, where characters may be written as entities."""
        if "&" not in text:
            return self._once(text)
        out, starts, ends, at = [], [], [], 0
        for m in _ENTITY.finditer(text):
            # what stands for a character beyond ASCII is read as that character
            if len(c := html.unescape(m.group())) == 1 and c > "\x7f":
                out += [text[at : m.start()], c]
                starts += [*range(at, m.start()), m.start()]
                ends += [*range(at + 1, m.start() + 1), m.end()]
                at = m.end()
        if not out:
            return self._once(text)
        starts += range(at, len(text))
        ends += range(at + 1, len(text) + 1)
        return [(starts[a], ends[b - 1], restored) for a, b, restored in self._once("".join([*out, text[at:]]))]

    def repair(self, text: str) -> tuple[bool, bool, str]:
        """(has a wrongly decoded passage, has one that cannot be restored, text as far as restored).

        Text may have been wrongly decoded more than once; every round makes it shorter or is the last.
        """
        changed = False
        while pieces := self._pieces(text):
            at, out = 0, []
            for a, b, restored in pieces:
                out += [text[at:a], restored]
                at = b
            after = "".join([*out, text[at:]])
            changed, longer, text = True, len(after) >= len(text), after
            if longer:
                # readings of single bytes keep the length and could go on for ever
                break
        lost = REPLACED in text
        return changed or lost, lost, text


def find_garbled(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts with a wrongly decoded passage: doc_id, restored_text, fully_restored.

    Null and empty texts have none. Texts in which nothing is wrong have no row, whatever symbols they hold.
    """
    spark = documents.sparkSession
    counts = count_pairs(documents, text).limit(MOST_PAIRS + 1).collect()
    if len(counts) > MOST_PAIRS:
        raise ValueError(f"more than {MOST_PAIRS} different character pairs")
    sent = spark.sparkContext.broadcast([(r[0], r[1], r[2]) for r in counts])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repairer = Repairer(PairModel(sent.value))
        for b in batches:
            rows = []
            for d, t in zip(b.doc_id, b.text):
                if t and (not t.isascii() or _ENTITY.search(t)):
                    wrong, lost, restored = repairer.repair(t)
                    if wrong:
                        rows.append((d, restored, not lost))
            yield pd.DataFrame(rows, columns=["doc_id", "restored_text", "fully_restored"])

    corpus = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    return corpus.mapInPandas(run, "doc_id long, restored_text string, fully_restored boolean")
