"""Free-entered values mapped to the entries of a canonical list.

Method: a symmetric-delete dictionary. Every written form of every entry is stored under all
strings that up to two deletions leave of it; the dictionary is broadcast, typed values are
looked up under their own deletions, and the candidates are ranked by weighted
Damerau-Levenshtein distance and by how often their entry is meant elsewhere. Values that
mean no entry are reported.

Numbers (roman or arabic) and lone letters at the end tell entries apart, so they must agree;
only the stem before them may differ.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

from slideloom.operators.multivalue import split_values
from slideloom.session import checkpointed

MOST_EDITS = 2
#: Letters that a name shortened without a full stop has at least.
SHORTEST_START = 6
#: Letters that one shortened with a full stop has at least.
SHORTEST_CUT = 4
#: Forms of a canonical list that is broadcast with their deletions; a longer one is joined by a shuffle.
BROADCAST_ENTRIES = 5_000

# Letters of other scripts that look like Latin ones, and the Greek letters.
_LOOKALIKES = str.maketrans("авекмнорстухіјѕԁԛԝзАВЕКМНОРСТУХІЈЅЗøØłŁđĐıß", "abekmhopctyxijsdqw3ABEKMHOPCTYXIJS3oOlLdDis")
_GREEK = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "ζ": "zeta", "η": "eta", "θ": "theta",
    "ι": "iota", "κ": "kappa", "λ": "lambda", "μ": "mu", "ν": "nu", "ξ": "xi", "π": "pi", "ρ": "rho", "σ": "sigma",
    "τ": "tau", "υ": "upsilon", "φ": "phi", "χ": "chi", "ψ": "psi", "ω": "omega",
}
_LETTER = {name: name[0] for name in _GREEK.values()}
_ROMAN = {r: str(n) for n, r in enumerate("i ii iii iv v vi vii viii ix x xi xii".split(), 1)}
_ARABIC = {n: r for r, n in _ROMAN.items()}
# Words that are added to a name without being part of it.
_ADDED = frozenset(
    "anti ab abs antibody antibodies mab pab clone fitc pe apc cy3 cy5 cy55 cy7 af488 af532 af555 af594 af647 af750 alexa fluor "
    "biotin hrp percp pecy7 dylight atto bv421 bv510 bv605 bv650 bv711 bv785 opal conj conjugate conjugated monoclonal polyclonal "
    "purified recombinant rabbit goat rat primary secondary marker stain channel total protein".split()
)


def simplified(value: str) -> str:
    """Lower case, compatibility forms and look-alike letters resolved, accents and invisible signs dropped."""
    text = unicodedata.normalize("NFKC", value).translate(_LOOKALIKES).lower()
    text = unicodedata.normalize("NFD", text).replace("ς", "σ").replace("ϐ", "β").replace("ϰ", "κ")
    return "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")


def words(value: str) -> list[str]:
    """The letter and digit runs of a simplified value; a full stop after a word stays with it."""
    return re.findall(r"[^\W_]+\.?", value)


def _latin(word: str, long: bool) -> str:
    return "".join((_GREEK[c] if long else _GREEK[c][0]) if c in _GREEK else c for c in word)


def _tail(tokens: list[str]) -> tuple[str, str]:
    """(stem, tail) of the words of a canonical name: its number or lone letter is the tail."""
    glued = "".join(tokens)
    last = tokens[-1]
    if len(tokens) > 1 and (last in _ROMAN or len(last) == 1 or (len(last) <= 3 and any(c.isdigit() for c in last))):
        return glued[: -len(last)], last
    if len(tokens) > 1 and last in _LETTER:
        return glued[: -len(last)], last
    m = re.search(r"\d+[a-z]?$|(?<=\d)[a-z]$", glued)
    return (glued[: m.start()], m.group()) if m else (glued, "")


@lru_cache(maxsize=65536)
def forms(entry: str, printed: str) -> tuple[tuple[str, str], ...]:
    """(stem, tail) of each way in which an entry may be written without spaces and signs."""
    out: dict[str, tuple[str, str]] = {}
    tokens = [w.rstrip(".") for w in words(simplified(printed or entry))]
    if not tokens:
        return ()
    for long in (False, True):
        plain = [_latin(t, long) for t in tokens]
        # A name's last word that is a Greek letter, alone or before a number, is a lone letter.
        m = re.fullmatch(r"([α-ω])(\d*)", tokens[-1])
        if m and len(tokens) > 1:
            stem = "".join(plain[:-1])
            out.setdefault(stem + plain[-1], (stem, plain[-1]))
            continue
        alternatives = [plain]
        if len(plain) > 1 and plain[-1] in _ROMAN:
            alternatives.append([*plain[:-1], _ROMAN[plain[-1]]])
        elif len(plain) > 1 and plain[-1] in _ARABIC:
            alternatives.append([*plain[:-1], _ARABIC[plain[-1]]])
        for a in alternatives:
            stem, tail = _tail(a)
            out.setdefault(stem + tail, (stem, tail))
    return tuple(out.values())


def deletions(form: str, most: int) -> set[str]:
    """All strings that at most ``most`` deletions leave of ``form``."""
    out = {form}
    level = {form}
    for _ in range(most):
        level = {s[:i] + s[i + 1 :] for s in level for i in range(len(s))}
        out |= level
    return out


def edits_allowed(stem: str) -> int:
    """Misspellings that a stem of this length may carry."""
    return 0 if len(stem) < 6 else 1 if len(stem) < 7 else MOST_EDITS


def distance(a: str, b: str, most: int) -> float:
    """Weighted Damerau-Levenshtein distance, or infinity where more than ``most`` edits are needed.

    A swap or a doubled letter weighs 0.7, another first letter 1.3, any other edit 1.
    """
    if abs(len(a) - len(b)) > most:
        return float("inf")
    inf = (most + 1, float("inf"))
    rows: list[list[tuple[int, float]]] = [[(j, float(j)) for j in range(len(b) + 1)]]
    for i in range(1, len(a) + 1):
        row = [(i, float(i))]
        for j in range(1, len(b) + 1):
            if abs(i - j) > most:
                row.append(inf)
                continue
            same = a[i - 1] == b[j - 1]
            first = 0.3 if i == 1 or j == 1 else 0.0
            options = [
                (rows[i - 1][j - 1][0] + (not same), rows[i - 1][j - 1][1] + (0 if same else 1 + first)),
                (rows[i - 1][j][0] + 1, rows[i - 1][j][1] + (0.7 if i > 1 and a[i - 1] == a[i - 2] else 1 + first)),
                (row[j - 1][0] + 1, row[j - 1][1] + 1 + first),
            ]
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                options.append((rows[i - 2][j - 2][0] + 1, rows[i - 2][j - 2][1] + 0.7))
            # A swap of letters between which one was dropped or put in.
            if i > 2 and j > 1 and a[i - 1] == b[j - 2] and a[i - 3] == b[j - 1]:
                options.append((rows[i - 3][j - 2][0] + 2, rows[i - 3][j - 2][1] + 1.7))
            if i > 1 and j > 2 and a[i - 1] == b[j - 3] and a[i - 2] == b[j - 1]:
                options.append((rows[i - 2][j - 3][0] + 2, rows[i - 2][j - 3][1] + 1.7))
            row.append(min(options, key=lambda o: (o[0] > most, o[1])))
        rows.append(row)
    count, weight = rows[-1][-1]
    return weight if count <= most else float("inf")


def readings(value: str) -> list[tuple[str, int, int]]:
    """(form, order, cut short) in which a typed value may be read, the plainest first.

    As typed; without what brackets hold; without added words. ``cut short`` is the length of
    the part before a full stop that ends a shortened name, 0 if there is none.
    """
    text = simplified(value)
    out: dict[str, tuple[int, int]] = {}

    def add(tokens: list[str]) -> None:
        if not tokens:
            return
        for long in (False, True):
            plain = [_latin(t, long) for t in tokens]
            cut = 0
            for k, t in enumerate(plain):
                if t.endswith(".") and (k == len(plain) - 1 or k == len(plain) - 2):
                    cut = len("".join(x.rstrip(".") for x in plain[: k + 1]))
            form = "".join(x.rstrip(".") for x in plain)
            out.setdefault(form, (len(out), cut))

    plain = words(text)
    add(plain)
    inner = [w for x in re.findall(r"[(\[{]([^)\]}]*)[)\]}]", text) for w in words(x)]
    outer = words(re.sub(r"[(\[{][^)\]}]*[)\]}]", " ", text))
    add(outer)
    kept = [w for w in outer if w.rstrip(".") not in _ADDED]
    add(kept)
    if len(inner) == 1 and inner[0] not in _ADDED:  # a first word put last, in brackets
        add([inner[0], *kept])
        add([*kept, inner[0]])
    if len(kept) > 1:
        add([*kept[1:], kept[0]])
    return [(form, k, cut) for form, (k, cut) in out.items()]


def agrees(value: str, form: str, stem: str, tail: str) -> bool:
    """Whether number and lone letter of a typed form are those of an entry's form."""
    if tail and not form.endswith(tail):
        return False
    digits = re.findall(r"\d+", form)
    if digits != re.findall(r"\d+", stem + tail):
        return False
    rest = form[: len(form) - len(tail)] if tail else form
    tokens = [w.rstrip(".") for w in words(simplified(value))]
    tokens = [t for t in tokens if t not in _ADDED]
    if tail in _ROMAN and tokens[-1:] != [tail]:
        run = re.search(r"[ivx]+$", form)
        own = re.search(r"[ivx]*$", stem)
        if run and len(run.group()) > len(tail) + len(own.group() if own else ""):
            return False
    if tail[:1].isdigit() and rest[-1:].isdigit():
        return False
    if not tail and len(tokens) > 1:
        last = _latin(tokens[-1], False)
        if len(last) == 1 or last in _ROMAN or last.isdigit():
            return False
    if tail and len(tokens) > 1:
        # A lone letter or number that is typed apart must be the tail, or its end, as a whole.
        last = tokens[-1]
        alone = {_latin(last, False), _latin(last, True)}
        if (len(last) == 1 or last in _ROMAN or last in _LETTER) and not alone & {tail, _LETTER.get(tail, tail), _ROMAN.get(tail, tail), _ARABIC.get(tail, tail)} and not tail.endswith(last):
            return False
    return True


_ENTRY = "entry string, stem string, tail string, form string"


def dictionary(reference: DataFrame, entry: str, printed: str) -> DataFrame:
    """(entry, stem, tail, form): every form of every entry. NULL entries are left out."""

    def batches(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows:
            found = [(e, s, t, s + t) for e, p in zip(batch["e"], batch["p"]) for pair in (forms(e, p or e), forms(e, e)) for s, t in pair]
            yield pd.DataFrame(found, columns=["entry", "stem", "tail", "form"])

    rows = reference.select(F.col(entry).alias("e"), F.coalesce(printed, entry).alias("p")).where("e is not null")
    # A form that a name's own spelling gives counts before one that its identifier gives.
    return rows.mapInPandas(batches, _ENTRY).groupBy("entry", "form").agg(F.min(F.struct(F.length("stem").alias("n"), "stem", "tail")).alias("s")).select(
        "entry", "s.stem", "s.tail", "form"
    )


def _with_deletions(rows: DataFrame, form: str, longest: int) -> DataFrame:
    """``rows`` with a column ``left``, one row per string that deletions leave of ``form``.

    A form longer than any entry by more than the edits allowed can't be near one and gives none.
    """

    @F.pandas_udf("array<string>")
    def left(values: pd.Series) -> pd.Series:
        return values.map(lambda v: sorted(deletions(v, MOST_EDITS)) if 4 <= len(v) <= longest + MOST_EDITS else [])

    return rows.withColumn("left", F.explode(left(F.col(form))))


def _typed_forms(values: DataFrame) -> DataFrame:
    """(value, form, nth, cut) for each distinct value."""

    def batches(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows:
            found = [(v, *r) for v in batch["value"] for r in readings(v)]
            yield pd.DataFrame(found, columns=["value", "form", "nth", "cut"])

    return values.mapInPandas(batches, "value string, form string, nth int, cut int")


def _costs(value: pd.Series, form: pd.Series, cut: pd.Series, stem: pd.Series, tail: pd.Series) -> pd.Series:
    out = []
    for v, f, c, s, t in zip(value, form, cut, stem, tail):
        if not agrees(v, f, s, t):
            out.append(None)
        elif f == s + t:
            out.append(0.0)
        else:
            own = f[: len(f) - len(t)] if t else f
            d = distance(own, s, edits_allowed(s))
            out.append(d if d < float("inf") else None)
    return pd.Series(out, dtype="float64")


def _cost() -> Column:
    """The distance of a reading from an entry's form; NULL where they can't mean the same."""
    return F.pandas_udf(_costs, DoubleType())("value", "form", "cut", "stem", "tail")


_FOUND = "value string, entry string, cost double, nth int"


@dataclass(frozen=True)
class Dictionary:
    """The forms of a canonical list and, under each string that deletions leave, the forms it may be of."""

    forms: tuple[tuple[str, str, str], ...]
    exact: dict[str, tuple[int, ...]]
    deleted: dict[str, tuple[int, ...]]
    begun: dict[str, tuple[int, ...]]
    longest: int

    def lookup(self, value: str, loose: bool) -> list[tuple[str, str, float, int]]:
        """(value, entry, cost, nth) of every entry that a typed value may mean."""
        found = []
        for form, nth, cut in readings(value):
            for k in self.exact.get(form, ()):
                entry, stem, tail = self.forms[k]
                if agrees(value, form, stem, tail):
                    found.append((value, entry, 0.0, nth))
            if loose and not cut and 4 <= len(form) <= self.longest + MOST_EDITS:
                near = {k for d in deletions(form, MOST_EDITS) for k in self.deleted.get(d, ())}
                for k in near:
                    entry, stem, tail = self.forms[k]
                    if agrees(value, form, stem, tail):
                        d = distance(form[: len(form) - len(tail)], stem, edits_allowed(stem))
                        if d < float("inf"):
                            found.append((value, entry, 1 + d, nth))
            if loose:
                found += self._begun(value, form, nth, cut)
        return found

    def _begun(self, value: str, form: str, nth: int, cut: int) -> list[tuple[str, str, float, int]]:
        """The one entry whose stem a shortened name starts, followed by the same number."""
        if not cut and len(form) >= SHORTEST_START and not re.search(r"\d", form):
            cut = len(form)
        if cut < SHORTEST_CUT:
            return []
        start, rest = form[:cut], form[cut:]
        entries = {e for e, stem, tail in map(self.forms.__getitem__, self.begun.get(start[:SHORTEST_CUT], ())) if stem.startswith(start) and rest == tail}
        return [(value, entries.pop(), 5.0, nth)] if len(entries) == 1 else []


def built(rows: list[tuple[str, str, str]]) -> Dictionary:
    """The dictionary of (entry, stem, tail) rows."""
    exact: dict[str, tuple[int, ...]] = {}
    deleted: dict[str, tuple[int, ...]] = {}
    begun: dict[str, tuple[int, ...]] = {}
    for k, (_, stem, tail) in enumerate(rows):
        begun[stem[:SHORTEST_CUT]] = (*begun.get(stem[:SHORTEST_CUT], ()), k)
        exact[stem + tail] = (*exact.get(stem + tail, ()), k)
        if edits_allowed(stem):
            for d in deletions(stem + tail, MOST_EDITS):
                deleted[d] = (*deleted.get(d, ()), k)
    return Dictionary(tuple(rows), exact, deleted, begun, max((len(s + t) for _, s, t in rows), default=0))


def _found_by_broadcast(values: DataFrame, rows: list[tuple[str, str, str]], loose: bool) -> DataFrame:
    """Every entry that each value may mean, by the broadcast dictionary."""
    shared = values.sparkSession.sparkContext.broadcast(built(rows))

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [r for v in frame["value"] for r in shared.value.lookup(v, loose)]
            yield pd.DataFrame(found, columns=["value", "entry", "cost", "nth"])

    return values.mapInPandas(batches, _FOUND)


def _found_by_join(values: DataFrame, entries: DataFrame, loose: bool) -> DataFrame:
    """The same by joins, for a canonical list too long to broadcast."""
    typed = _typed_forms(values)
    exact = typed.join(entries, "form").withColumn("cost", _cost())
    exact = exact.where("cost is not null").select("value", "entry", F.lit(0.0).alias("cost"), "nth")
    if not loose:
        return exact
    longest = entries.agg(F.max(F.length("form"))).first()[0] or 0
    index = _with_deletions(entries.where(F.length("stem") >= 6), "form", longest)
    near = _with_deletions(typed.where("cut = 0"), "form", longest).join(index.withColumnRenamed("form", "of"), "left")
    near = near.dropDuplicates(["value", "form", "entry", "of"]).withColumn("cost", _cost())
    near = near.where("cost is not null").select("value", "entry", (1 + F.col("cost")).alias("cost"), "nth")
    plain = F.when((F.length("form") >= SHORTEST_START) & ~F.col("form").rlike(r"\d"), F.length("form")).otherwise(0)
    cut = typed.withColumn("cut", F.when(F.col("cut") > 0, F.col("cut")).otherwise(plain))
    short = cut.where("cut >= 4").withColumn("start", F.substring("form", 1, 4)).join(
        entries.withColumn("start", F.substring("stem", 1, 4)).withColumnRenamed("form", "of"), "start"
    )
    short = short.where("startswith(stem, substring(form, 1, cut)) and substring(form, cut + 1) = tail")
    short = short.withColumn("many", F.size(F.collect_set("entry").over(Window.partitionBy("value", "form")))).where("many = 1")
    return exact.unionByName(near).unionByName(short.select("value", "entry", F.lit(5.0).alias("cost"), "nth"))


def meanings(values: DataFrame, entries: DataFrame, loose: bool = True, most_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """(value, entry): what each distinct value means; values that mean nothing have no row.

    ``loose`` False takes exact forms only. ``entries`` comes from :func:`dictionary`; its
    forms are broadcast while they are at most ``most_entries``, else they are joined. Each
    distinct value is looked up once, however many rows hold it.
    """
    distinct = values.where("value is not null").distinct()
    rows = [tuple(r) for r in entries.select("entry", "stem", "tail").orderBy("entry", "form").limit(most_entries + 1).collect()]
    found = checkpointed(_found_by_broadcast(distinct, rows, loose) if len(rows) <= most_entries else _found_by_join(distinct, entries, loose))
    best = found.groupBy("value", "entry").agg(F.min(F.struct("cost", "nth")).alias("b"))
    # Frequency of an entry: how many different values mean it exactly.
    often = found.where("cost = 0").groupBy("entry").agg(F.countDistinct("value").alias("often"))
    ranked = best.join(often, "entry", "left").groupBy("value").agg(
        F.min(F.struct(F.col("b.cost"), (-F.coalesce("often", F.lit(0))).alias("often"), F.col("b.nth"), "entry")).alias("f")
    )
    return ranked.select("value", "f.entry")


def matched(rows: DataFrame, reference: DataFrame, key: str, value: str, aliases: str | None, entry: str, printed: str) -> DataFrame:
    """(key, entry) of each row whose value, or else whose first telling alias, means an entry.

    Values are looked up once per distinct spelling. NULL, blank and unknown values have no
    row; repeated rows each have theirs. Of equally near entries the one meant more often
    counts, then the first in order. Empty tables give no row.
    """
    entries = checkpointed(dictionary(reference, entry, printed))
    typed = rows.select(F.col(key).alias("_key"), F.col(value).alias("value"), *([F.col(aliases).alias("_aliases")] if aliases else []))
    judged = checkpointed(typed.join(meanings(typed.select("value"), entries), "value", "left"))
    direct = judged.where("entry is not null").select("_key", "entry")
    if aliases is None:
        return direct.toDF(key, entry)
    rest = judged.where("entry is null").select("_key", "_aliases")
    alias = checkpointed(split_values(rest, "_key", "_aliases", "value"))
    told = alias.join(meanings(alias.select("value"), entries, loose=False), "value")
    by_alias = told.groupBy("_key").agg(F.min(F.struct("position", "entry")).alias("f")).select("_key", "f.entry")
    return direct.unionByName(by_alias).toDF(key, entry)


def misses(rows: DataFrame, found: DataFrame, key: str, value: str) -> DataFrame:
    """(value, n_rows): the values of rows without a match, with how often each is typed."""
    return rows.join(found.select(key), key, "left_anti").groupBy(value).agg(F.count("*").alias("n_rows"))
