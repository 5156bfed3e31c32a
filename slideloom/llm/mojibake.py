"""Text that was decoded with the wrong character encoding: found and restored.

Method: every chain of wrong decodings that a stretch of text may have gone through is undone;
each result is compressed with zstandard dictionaries, one per language, and the chain with
the shortest description - compressed bytes, plus the cost of the chain and of signs that no
language uses - is chosen. Where no chain is shorter than the text as it is, the text stays
unchanged.

Words, signs and dictionaries are learnt from all labelled texts, counted where they lie; everything
else is done per text.
"""

from __future__ import annotations

import codecs
import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from slideloom.functions.text import strip
from slideloom.session import checkpointed, spread

DICTIONARY_BYTES = 65_536
#: Characters of the texts that a task trains a dictionary on, about; dictionaries that are then made one at a time.
BUCKET_CHARS = 1_000_000
MERGED = 16
#: Texts that a language has at least to be learnt.
LEAST_TEXTS = 8
#: Share of a language's texts in which a sign, a pair or a word has to stand; rarer ones may be those of garbled texts.
LEARNT_SHARE = 1 / 600
#: Counts that a task holds before it hands them on.
MOST_COUNTS = 200_000
LEVEL = 6
#: Bytes that a chain costs per step, by whether a wrong guess would usually not decode at all.
STEP_COST = 1.0
FREE_STEP_COST = 6.0
#: Bytes that each different word costs that stands in fewer than two texts.
UNKNOWN_COST = 4.0
#: Bytes that such a word costs more where it mixes Latin letters with Greek or Cyrillic ones.
MIXED_COST = 8.0
#: Bytes of a compressed text at least, and bits of signs that a step has to save which nearly any text passes.
LEAST_BYTES = 8.0
LEAST_SAVED = 4.0
#: Bits of a sign that no text has, and of a pair of signs that none has beyond the second sign's own.
NEW_SIGN_BITS = 20.0
NEW_PAIR_BITS = 4.0
#: Bytes that each sign costs that the language does not use, and that no text
#: holds; texts, and share of a language's texts, that make a sign usual.
STRANGE_COST = 4.0
UNSEEN_COST = 8.0
USUAL_TEXTS = 3
USUAL_SHARE = 0.01
#: Bytes that a stretch in another language than its text's costs.
SWITCH_COST = 3.0
#: Share of the texts below which a word may be one that was wrongly decoded.
RARE_SHARE = 0.005
#: Characters of a stretch, about; work per stretch may grow faster than its length.
STRETCH_CHARS = 400
#: Wrong decodings that may lie on top of each other.
MOST_STEPS = 3

# Fixed values: (encoding the text was read with, encoding it was in).
SELF_CHECKING = tuple((w, "utf-8") for w in ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8-r", "cp866", "cp1250", "iso8859-15", "cp932")) + (
    ("cp1252", "cp932"), ("cp1252", "euc_jp"), ("mac_roman", "cp932"), ("cp437", "cp932"), ("cp1251", "cp932"), ("cp1252", "gb18030"),
)
FREE = (
    ("cp1252", "cp1251"), ("cp1252", "koi8-r"), ("cp1252", "cp866"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"),
    ("cp1251", "koi8-r"), ("cp1251", "cp866"), ("cp1251", "cp1252"), ("koi8-r", "cp1251"), ("koi8-r", "cp866"), ("koi8-r", "cp1252"),
    ("cp866", "cp1251"), ("cp866", "koi8-r"), ("mac_roman", "cp1252"), ("mac_roman", "cp1251"), ("cp437", "cp1252"), ("cp437", "cp1251"),
    ("cp850", "cp1252"), ("cp1250", "cp1252"), ("iso8859-2", "cp1252"), ("mac_cyrillic", "cp1251"), ("iso8859-5", "cp1251"), ("cp1253", "cp1252"),
)
# UTF-8 of which some bytes were dropped, as they stand for no sign in the wrong encoding.
_LOSSY = "utf-8 with lost bytes"
LOSSY = tuple((w, _LOSSY) for w in ("cp1252", "mac_roman", "cp437", "cp1251"))
_MULTIBYTE = {"cp932", "euc_jp", "gb18030", "utf-8"}
# Labels that name no language.
NO_LANGUAGE = ("und", "mul", "mis", "zxx")
# Signs that every language uses.
_TYPOGRAPHIC = frozenset("‐‑–—‘’“”„…«»™®©")
# Signs lost: U+FFFD, and C1 controls but NEL.
_LOST = re.compile("[\ufffd\x80-\x84\x86-\x9f]")
# The start of a character of four bytes read as cp1252, of which the rest was dropped.
_CUT = re.compile("\xf0[\x90-\xbf‘’“”•–—˜™š›œžŸ]")


@lru_cache(maxsize=None)
def _encoder(name: str) -> dict[int, int]:
    """Character -> byte of a single-byte encoding; bytes it leaves out stand for C1 signs."""
    table = {ord(bytes([b]).decode(name, "ignore") or chr(b)): b for b in range(256)}
    if name in ("cp1252", "iso8859-15"):
        for b in range(0x80, 0x100):  # the same text read as ISO 8859-1
            table.setdefault(b, b)
    return table


@lru_cache(maxsize=None)
def _decoder(name: str) -> str:
    return "".join(bytes([b]).decode(name, "ignore") or chr(b) for b in range(256))


def undone(text: str, wrong: str, right: str) -> str | None:
    """``text`` as it reads when its bytes under ``wrong`` are decoded as ``right``; None if they can't be.

    With lost bytes at most a third of the signs may be U+FFFD, and one at least has to take several bytes.
    """
    try:
        raw = text.encode(wrong) if wrong in _MULTIBYTE else codecs.charmap_encode(text, "strict", _encoder(wrong))[0]
        if right == _LOSSY:
            found = raw.decode("utf-8", "replace")
            lost = found.count("\ufffd")
            return found if 0 < 3 * lost <= len(found) and any(c > "\x7f" and c != "\ufffd" for c in found) else None
        return raw.decode(right) if right in _MULTIBYTE else codecs.charmap_decode(raw, "strict", _decoder(right))[0]
    except UnicodeError:
        return None


_PAIRS = SELF_CHECKING + FREE + LOSSY
#: Only UTF-8 checks itself: nearly any text passes as a single-byte encoding, and short ones as other multi-byte encodings.
_COSTS = [STEP_COST if right == "utf-8" and wrong != "cp932" else FREE_STEP_COST for wrong, right in _PAIRS]
_SAVED = [-math.inf if cost == STEP_COST else LEAST_SAVED for cost in _COSTS]


@lru_cache(maxsize=10_000)
def _readings(word: str) -> tuple[tuple[int, str], ...]:
    """(number of the pair, the word undone) of each pair that changes a word."""
    if word.isascii():
        return ()
    found = ((k, undone(word, wrong, right)) for k, (wrong, right) in enumerate(_PAIRS))
    return tuple((k, new) for k, new in found if new is not None and new != word and not any("\x00" <= c < "\x09" for c in new))


#: A word that holds a sign beyond ASCII, between blanks.
_MARKED = re.compile(r"[^ \n\t]*[^\x00-\x7f \n\t][^ \n\t]*")
_LONG = re.compile(rf".{{1,{STRETCH_CHARS}}}(?=[ \n\t]|\Z)|[^ \n\t]+|[ \n\t]", re.DOTALL)
_BLANKS = re.compile(r"([ \n\t]+)")
_MIXED = re.compile(r"[A-Za-z].*[\u0370-\u052f]|[\u0370-\u052f].*[A-Za-z]")
_ZERO = re.compile(r"\d")
_WORD = re.compile(r"[^\s、。，；：！？（）「」.,;:!?()\"]+")


def _words(text: str) -> Counter[str]:
    """The words with a sign beyond ASCII, in lower case, with every digit as 0."""
    return Counter(w.lower() for w in _written(text))


def _written(text: str) -> list[str]:
    return [_ZERO.sub("0", w) for w in _WORD.findall(text) if not w.isascii()]


@dataclass(frozen=True)
class Model:
    """Dictionaries per language, usual signs, in how many texts a word stands, and bits of signs.

    ``signs`` and ``pairs`` hold, of a sign and of a sign after another one, the bits it takes
    in the language that uses it most.
    """

    dictionaries: dict[str, bytes]
    usual: dict[str, frozenset[str]]
    words: dict[str, int]
    signs: dict[str, float]
    pairs: dict[str, float]

    def bits(self, word: str) -> float:
        """Bits of a word by its pairs of signs."""
        padded = f" {_ZERO.sub('0', word)} "
        pairs, signs = self.pairs, self.signs
        total = 0.0
        for k in range(len(padded) - 1):
            own = pairs.get(padded[k : k + 2])
            total += signs.get(padded[k + 1], NEW_SIGN_BITS) + NEW_PAIR_BITS if own is None else own
        return total


class _Measure:
    """Description lengths under a model; made once per task."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.compressors = []
        for language, data in model.dictionaries.items():
            kept = zstandard.ZstdCompressionDict(data)
            kept.precompute_compress(level=LEVEL)
            own = zstandard.ZstdCompressor(dict_data=kept, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            self.compressors.append((own, model.usual[language] | _TYPOGRAPHIC))
        self.chosen: dict[tuple[str, int], str | None] = {}
        self.seen: dict[str, tuple[tuple[int, str, float], ...]] = {}

    def outlook(self, word: str) -> tuple[tuple[int, str, float], ...]:
        """(number of the pair, the word undone, bits of signs that it saves) of each pair that changes a word."""
        known = self.seen.get(word)
        if known is None:
            readings = _readings(word)
            bits = self.model.bits(word) if readings else 0.0
            known = tuple((k, new, bits - self.model.bits(new)) for k, new in readings)
            if len(self.seen) > 20_000:
                self.seen.clear()
            self.seen[word] = known
        return known

    def hopeful(self, text: str) -> bool:
        """Whether any word of a text has a reading that may be a candidate's."""
        return any(saved >= _SAVED[k] for word in set(_MARKED.findall(text)) for k, _, saved in self.outlook(word))

    def undone(self, text: str) -> list[tuple[float, str]]:
        """(cost, text) of each candidate that undoes one wrong decoding.

        A step that nearly any text passes has to save LEAST_SAVED bits of signs in all.
        """
        parts = _BLANKS.split(text)
        saved: dict[int, float] = {}
        for part in parts:
            if not part.isascii():
                for k, _, bits in self.outlook(part):
                    saved[k] = saved.get(k, 0.0) + bits
        found = []
        for k, bits in saved.items():
            if bits >= _SAVED[k]:
                found.append((_COSTS[k], "".join([next((new for j, new, _ in self.outlook(p) if j == k), p) for p in parts])))
        return sorted(found)

    def home(self, text: str) -> int:
        """The language that describes a whole text best."""
        raw, signs = text.encode("utf-8", "surrogatepass"), {c for c in text if c > "\x7f"}
        sizes = [len(own.compress(raw)) + self.strange(signs, usual) for own, usual in self.compressors]
        return sizes.index(min(sizes)) if sizes else 0

    def strange(self, signs: set[str], usual: frozenset[str]) -> float:
        return sum(STRANGE_COST if c in self.model.signs else UNSEEN_COST for c in signs - usual)

    def __call__(self, text: str, home: int, below: float = math.inf) -> float:
        """The description length of a stretch in a text of a language, or ``below`` if it isn't less.

        A language is left out where its signs alone cost as much.
        """
        raw, signs = text.encode("utf-8", "surrogatepass"), {c for c in text if c > "\x7f"}
        words = sum(UNKNOWN_COST + MIXED_COST * (_MIXED.search(w) is not None) for w in _words(text) if w not in self.model.words)
        if not self.compressors:
            return min(below, len(raw) + words)
        known = [(words + SWITCH_COST * (k != home) + self.strange(signs, usual), k) for k, (_, usual) in enumerate(self.compressors)]
        for fixed, k in sorted(known):
            if fixed + LEAST_BYTES >= below:
                break
            below = min(below, fixed + len(self.compressors[k][0].compress(raw)))
        return below

    def best(self, stretch: str, home: int) -> str | None:
        """The candidate with the shortest description, None where the stretch itself is shortest."""
        key = (stretch, home)
        if key in self.chosen:
            return self.chosen[key]
        best = self._best(stretch, home)
        if len(stretch) <= 500:  # stretches come again, long ones hardly do
            if len(self.chosen) > 5_000:
                self.chosen.clear()
            self.chosen[key] = best
        return best

    def _best(self, stretch: str, home: int) -> str | None:
        """Each step of a chain has to shorten the description, with the costs of all steps in it."""
        if not self.hopeful(stretch):
            return None
        least, best = self(stretch, home), None
        level, seen = [(stretch, 0.0, least)], {stretch}
        for _ in range(MOST_STEPS):
            following = []
            for at, paid, before in level:
                for step, option in self.undone(at):
                    cost = paid + step
                    if option in seen or cost + LEAST_BYTES >= before:
                        continue
                    seen.add(option)
                    length = self(option, home, before - cost) + cost
                    if length < before:
                        following.append((option, cost, length))
                        if length < least:
                            least, best = length, option
            level = following
        return best


def _stretches(text: str) -> list[str]:
    """The text cut after sentences, and long ones before blanks; the cuts keep all signs."""
    sentences = re.split(r"(?<=[.!?。！？\n])(?=\s)|(?<=[。！？\n])", text)
    return [x for s in sentences if s for x in ([s] if len(s) <= STRETCH_CHARS else _LONG.findall(s))]


def _clauses(stretch: str) -> list[str]:
    return [x for x in re.split(r"(?<=[,;:、–—()])(?=\s)|(?<=[、，])", stretch) if x]


def _plain(text: str) -> str:
    """A text with its character references read, also those of references."""
    for _ in range(2):
        if "&" in text:
            text = html.unescape(text)
    return text


def restored(text: str, measure: _Measure) -> tuple[str, bool]:
    """(text with its garbled stretches restored, whether it was garbled at all).

    Signs lost for good (U+FFFD, stray C1 controls) tell of a wrong decoding that can't be
    undone; such stretches are restored as far as they can be. Character references are read
    first; alone they are no garbling.
    """
    if text.isascii() and "&" not in text:
        return text, False
    whole = _plain(text)
    if not measure.hopeful(whole) and not _LOST.search(whole) and not _CUT.search(whole):
        return text, False
    home = measure.home(text)
    out, found = [], False
    for stretch in _stretches(text):
        plain = _plain(stretch)
        if plain.isascii():
            out.append(stretch)
            continue
        best = measure.best(plain, home)
        if best is None:
            parts = _clauses(plain)
            if len(parts) > 1:
                undone_parts = [None if p.isascii() else measure.best(p, home) for p in parts]
                if any(p is not None for p in undone_parts):
                    best = "".join(n if n is not None else p for n, p in zip(undone_parts, parts))
        found = found or best is not None or _LOST.search(plain) is not None or _CUT.search(plain) is not None
        out.append(best if best is not None else stretch)
    return "".join(out), found


def _clean(text: str) -> bool:
    """Whether a text shows no sign of a wrong decoding that would decode."""
    if _LOST.search(text) or "\x85" in text:
        return False
    return not any(_PAIRS[k][1] == "utf-8" and _PAIRS[k][0] != "cp932" for word in _MARKED.findall(text) for k, _ in _readings(word))


def _suspect(words: Counter[str], written: Counter[str], texts: int) -> set[str]:
    """Rare words, as written, that some pair turns into a word of four signs or more that is over five times as frequent."""
    rare = max(USUAL_TEXTS, RARE_SHARE * texts)
    return {w for w, n in written.items() if n <= rare and any(words.get(v, 0) > 5 * n and len(v) > 3 for _, new in _readings(w) for v in _words(new))}


_COUNTS = "kind string, lang string, key string, n bigint"


def _counted(texts: DataFrame, tally: Callable[[Counter, str, str], None]) -> DataFrame:
    """(kind, lang, key, n): what ``tally`` counts of all texts (_lang, _text); tasks add up before rows meet."""

    def frame(counts: Counter[tuple[str, str, str]]) -> pd.DataFrame:
        return pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["kind", "lang", "key", "n"])

    def batches(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[tuple[str, str, str]] = Counter()
        for batch in rows:
            for lang, text in zip(batch["_lang"], batch["_text"]):
                tally(counts, lang, text)
                if len(counts) > MOST_COUNTS:
                    yield frame(counts)
                    counts.clear()
        yield frame(counts)

    return texts.mapInPandas(batches, _COUNTS).groupBy("kind", "lang", "key").agg(F.sum("n").alias("n"))


def _tally_words(counts: Counter, lang: str, text: str) -> None:
    """Of clean texts: in how many a word stands, in lower case and as written."""
    if _clean(text):
        counts["text", "", ""] += 1
        counts.update(("word", "", w) for w in _words(text))
        counts.update(("written", "", w) for w in set(_written(text)))


def _tally(counts: Counter, lang: str, text: str) -> None:
    """Of a text that is learnt from: in how many a word or sign stands, and how often signs and pairs of signs do."""
    counts["text", lang, ""] += 1
    counts["chars", lang, ""] += len(text)
    counts.update(("word", lang, w) for w in _words(text))
    counts.update(("sign", lang, c) for c in set(text) if c > "\x7f")
    for case, own in (("", text), ("upper ", text.upper())):
        padded = f" {_ZERO.sub('0', own)} "
        for one, n in Counter(padded[1:]).items():
            counts[case + "one", lang, one] += n
        for two, n in Counter(map("".join, zip(padded, padded[1:]))).items():
            counts[case + "two", lang, two] += n


def _own(text: str, suspect: set[str]) -> bool:
    return _clean(text) and suspect.isdisjoint(_written(text))


def _readings_of(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in rows:
        found = [(w, n, v) for w, n in zip(batch["key"], batch["n"]) for _, new in _readings(w) for v in _words(new) if len(v) > 3]
        yield pd.DataFrame(found, columns=["written", "k", "key"])


def train(documents: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id") -> Model:
    """The model of all labelled texts.

    Labels are trimmed and compared without case; texts without a label, those of at most 20 signs, and
    texts that would decode as a wrong decoding of UTF-8, are not learnt from. To the driver come
    counts of signs, words of two texts or more, suspect words and a dictionary per language.
    """
    label = F.split(F.lower(strip(F.col(language))), "[-_]")[0]
    labelled = documents.select(F.col(key).alias("_key"), label.alias("_lang"), F.col(text).alias("_text"))
    texts = labelled.where(~F.col("_lang").isin("", *NO_LANGUAGE) & (F.length("_text") > 20)).distinct().select("_lang", "_text")
    counted = checkpointed(_counted(texts, _tally_words))
    total = sum(r["n"] for r in counted.where("kind = 'text'").collect())
    rare = counted.where((F.col("kind") == "written") & (F.col("n") <= max(USUAL_TEXTS, RARE_SHARE * total))).select("key", "n")
    words = counted.where("kind = 'word'").select("key", "n")
    turned = rare.mapInPandas(_readings_of, "written string, k bigint, key string").join(words, "key").where("n > 5 * k")
    suspect = {r["written"] for r in turned.select("written").distinct().collect()}
    shared = documents.sparkSession.sparkContext.broadcast(suspect)

    def kept(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows:
            yield batch[np.array([_own(t, shared.value) for t in batch["_text"]], bool)]

    own = texts.mapInPandas(kept, "_lang string, _text string")
    tallied = checkpointed(_counted(own, _tally))
    signs = [tuple(r) for r in tallied.where("kind <> 'word'").collect()]
    learnt = [lang for kind, lang, _, n in signs if kind == "text" and n >= LEAST_TEXTS]
    texts_of = {lang: n for kind, lang, _, n in signs if kind == "text"}
    word_of = tallied.where((F.col("kind") == "word") & F.col("lang").isin(learnt))
    if learnt:
        enough = F.create_map(*[F.lit(x) for lang in learnt for x in (lang, LEARNT_SHARE * texts_of[lang])])[F.col("lang")]
        word_of = word_of.withColumn("usual", F.col("n") >= enough)
    else:
        word_of = word_of.withColumn("usual", F.lit(False))
    known = word_of.groupBy("key").agg(F.sum("n").alias("n"), F.max("usual").alias("usual")).where("n > 1 and usual")
    chars = {lang: n for kind, lang, _, n in signs if kind == "chars" and lang in learnt}
    return _model(signs, {r["key"]: r["n"] for r in known.collect()}, _dictionaries(own, chars))


def _dictionaries(texts: DataFrame, chars: dict[str, int]) -> dict[str, bytes]:
    """A dictionary per language, from all of its texts: one per BUCKET_CHARS, of which MERGED at a time are made one."""
    if not chars:
        return {}
    buckets = {lang: -(-n // BUCKET_CHARS) for lang, n in chars.items()}
    many = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair])

    def trained(rows: pd.DataFrame) -> pd.DataFrame:
        pieces = [s.strip().encode("utf-8", "replace") for t in sorted(rows["_text"]) for s in _stretches(t) if s.strip()]
        return rows[["_lang", "bucket"]].head(1).assign(data=[_dictionary(pieces)])

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        if len(rows) > 1:  # a dictionary's tables stand before its strings
            pieces = [data[k : k + 256] for data in rows["data"] for k in range(256, len(data), 256)]
            rows = rows.head(1).assign(data=[_dictionary(pieces)])
        return rows[["_lang", "bucket", "data"]]

    made = texts.where(F.col("_lang").isin(*chars)).withColumn("bucket", F.pmod(F.xxhash64("_text"), many[F.col("_lang")].cast("bigint")))
    made = made.groupBy("_lang", "bucket").applyInPandas(trained, "_lang string, bucket bigint, data binary")
    most = max(buckets.values())
    while most > 1:
        parts = made.select("_lang", F.col("bucket").alias("part"), F.floor(F.col("bucket") / MERGED).alias("bucket"), "data")
        made = parts.groupBy("_lang", "bucket").applyInPandas(merged, "_lang string, bucket bigint, data binary")
        most = -(-most // MERGED)
    return {r["_lang"]: bytes(r["data"]) for r in made.collect()}


def _dictionary(pieces: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the texts themselves are the dictionary
        return b"\n".join(pieces)[-DICTIONARY_BYTES:]


def fit(by_language: dict[str, list[str]]) -> Model:
    """The model of texts per language that are at hand; a language of fewer than eight texts is left out.

    Texts with words that look wrongly decoded beside more frequent words are left out too.
    """
    counts = Counter(w for own in by_language.values() for t in own for w in _words(t).keys())
    written = Counter(w for own in by_language.values() for t in own for w in set(_written(t)))
    suspect = _suspect(counts, written, sum(map(len, by_language.values())))
    dictionaries, tallied = {}, Counter()
    for name, texts in by_language.items():
        own = [t for t in texts if suspect.isdisjoint(_written(t))]
        if len(own) >= LEAST_TEXTS:
            for t in own:
                _tally(tallied, name, t)
            dictionaries[name] = _dictionary([s.strip().encode("utf-8", "replace") for t in own for s in _stretches(t) if s.strip()])
    words: Counter[str] = Counter()
    frequent = set()
    for (kind, lang, w), n in tallied.items():
        if kind == "word":
            words[w] += n
            if n >= LEARNT_SHARE * tallied["text", lang, ""]:
                frequent.add(w)
    return _model([(*k, n) for k, n in tallied.items()], {w: n for w, n in words.items() if n > 1 and w in frequent}, dictionaries)


def _model(counts: list[tuple[str, str, str, int]], words: dict[str, int], dictionaries: dict[str, bytes]) -> Model:
    """The model of counts (kind, language, key, n) as of ``_tally``, for the languages with a dictionary."""
    of: dict[tuple[str, str], dict[str, int]] = {}
    for kind, lang, key, n in counts:
        of.setdefault((kind, lang), {})[key] = n
    usual: dict[str, frozenset[str]] = {}
    sign_bits: dict[str, float] = {}
    pair_bits: dict[str, float] = {}
    for name in sorted(dictionaries):
        least = max(USUAL_TEXTS, USUAL_SHARE * of["text", name][""])
        held = of.get(("sign", name), {})
        usual[name] = frozenset(c for c, n in held.items() if n >= least)
        enough = LEARNT_SHARE * of["text", name][""]
        for case in ("", "upper "):
            ones, twos = of[case + "one", name], of[case + "two", name]
            signs = {c: n for c, n in ones.items() if c <= "\x7f" or held.get(c, 0) + held.get(c.lower(), 0) >= enough}
            pairs = {p: n for p, n in twos.items() if p.isascii() or n >= enough and p[1] in signs}
            _learn_signs(signs, pairs, sign_bits, pair_bits)
    return Model(dict(sorted(dictionaries.items())), usual, words, sign_bits, pair_bits)


def _learn_signs(ones: dict[str, int], twos: dict[str, int], sign_bits: dict[str, float], pair_bits: dict[str, float]) -> None:
    """Lowers the bits of signs, and of signs after another one, to those of a language's counts."""
    total = sum(ones.values())
    before = Counter()
    for two, n in twos.items():
        before[two[0]] += n
    for sign, n in ones.items():
        sign_bits[sign] = min(sign_bits.get(sign, NEW_SIGN_BITS), math.log2(total / n))
    for two, n in twos.items():
        own = math.log2((before[two[0]] + 1) / n)
        pair_bits[two] = min(pair_bits.get(two, NEW_SIGN_BITS + NEW_PAIR_BITS), own)


def repair(documents: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, garbled, restored): every text with its wrong decodings undone where possible.

    A NULL text stays NULL and is not garbled, as an empty one; repeated rows are each
    judged; other columns are ignored; an empty table gives no row. The model is sent to the
    tasks: a dictionary of DICTIONARY_BYTES per language, signs, and words of two texts or more.
    """
    model = model or train(documents, text=text, key=key)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def batches(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        measure = _Measure(shared.value)
        for batch in rows:
            found = [(None, False) if t is None else restored(t, measure) for t in batch.iloc[:, 1]]
            yield pd.DataFrame({key: batch.iloc[:, 0], "garbled": [g for _, g in found], "restored": pd.Series([t for t, _ in found], dtype=object)})

    rows = spread(documents.select(F.col(key), F.col(text)))
    return rows.mapInPandas(batches, f"`{key}` {rows.schema[key].dataType.simpleString()}, garbled boolean, restored string")
