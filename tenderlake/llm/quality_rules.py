"""Weak supervision for text quality.

Rules vote that a text is good (1) or bad (-1), or abstain (0). Each rule
belongs to a family that looks at one kind of bad text by several signs.
Expectation-maximisation over the counts of vote patterns estimates each rule's
accuracy by class and the share of each class without labels: good texts, and
the bad ones of each family. A text's posterior probability of being good then
decides, instead of demanding that all rules pass: a bad vote that the other
signs of its family contradict is outvoted, and how much it takes to outvote a
rule is estimated from the corpus.

The patterns are at most 3 ** (number of rules) rows whatever the input's size,
and in practice some hundred; only they reach the driver. The posterior is a
logistic of the votes' weights and stays a column expression.

Null, empty and blank texts have figures of zero, fail the base rule and get a
bad vote from every rule. Rows that are alike are judged alike, each for itself.
Columns of the input that have names of FEATURES are replaced by with_features()
and left alone by only_kept(). An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, aside, placed, with_columns, written

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: What is thought of a rule before any text is seen (the chance that its vote is right) and how many texts that thought is worth.
THOUGHT, WORTH = 0.9, 10.0
#: Marks that end a sentence (of several bytes: … 。 ！ ？ ।), and the last bytes of words in running text besides letters and digits.
SENTENCE_ENDS, LONG_ENDS = b".?!", tuple(x.encode() for x in "…。！？।")
PLAIN_ENDS = b".,;:?!'\")]}-/"
FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_upper long, n_lower long, n_marks long, n_ends long,"
    " n_symbol_words long, n_odd_ends long, n_distinct long, n_loud_words long, n_upper_words long"
)


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by windows of width words that occur twice or more in the text."""
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return _repeated(np.fromiter(map(index.__getitem__, words), np.int64, len(words)), len(index), width)


def _repeated(ids: np.ndarray, distinct: int, width: int = WINDOW) -> int:
    """The same for words told by numbers below distinct."""
    n = len(ids)
    if n <= width:
        return 0
    code, span = ids, distinct
    for k in range(1, width):
        if span * distinct >= 2**62:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            span = int(code.max()) + 1
        code = code[: n - k] * distinct + ids[k:]
        span *= distinct
    ordered = np.sort(code)
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    often = np.unique(ordered[1:][same])
    at = np.minimum(np.searchsorted(often, code), len(often) - 1)
    starts = np.flatnonzero(often[at] == code)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def _table(*members: bytes) -> np.ndarray:
    """For each byte whether it is among the members."""
    out = np.zeros(256, bool)
    out[list(b"".join(members))] = True
    return out


_SPACE = _table(SPACE.encode())
_SYMBOL, _UPPER, _MARK, _END = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(b"!?"), _table(SENTENCE_ENDS)
_PLAIN = _table(PLAIN_ENDS, bytes(range(48, 58)), bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(128, 256)))
_OTHERS = re.compile("[^\x00-\x7f]+")


def _by_word(raw: np.ndarray, seen: np.ndarray) -> tuple[int, int, int, int, int]:
    """Words that end a sentence, hold a symbol, end oddly, end loudly, and are in capitals. seen counts the bytes."""
    word = np.zeros(len(raw) + 2, np.int8)
    np.logical_not(_SPACE[raw], out=word[1:-1].view(bool))
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]  # ends are one past a word's last byte
    if not len(starts):
        return 0, 0, 0, 0, 0
    last = raw[ends - 1]
    ended, loud = _END[last], 0
    if seen[[x[2] for x in LONG_ENDS]].any():
        two, three = (np.where(ends - starts >= n, raw[np.maximum(ends - n, 0)], 0) for n in (2, 3))
        for x in LONG_ENDS:
            ended = ended | (last == x[2]) & (two == x[1]) & (three == x[0])
    if seen[[33, 63]].any():
        loud = int((_MARK[last] & _MARK[raw[np.maximum(ends - 2, 0)]] & (ends - starts > 1)).sum())
    holding = lambda table: np.unique(np.searchsorted(ends, np.flatnonzero(table[raw]), "right"))  # noqa: E731  the words with such a byte
    symbols = len(holding(_SYMBOL)) if seen[_SYMBOL].any() else 0
    # few words have a capital
    capitals = 0
    if seen[_UPPER].any():
        held = holding(_UPPER)
        text = raw.tobytes()
        capitals = sum(1 for s, e in zip(starts[held].tolist(), ends[held].tolist()) if e - s > 1 and text[s:e].isupper())
    return int(np.count_nonzero(ended)), symbols, len(last) - int(np.count_nonzero(_PLAIN[last])), loud, capitals


def features_of(text: str | None) -> tuple[int, ...]:
    """The figures that the rules look at; all zero for null and for empty texts."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() separates at exactly the six white-space bytes
    seen = np.zeros(256, np.int64)
    whole = np.frombuffer(raw, np.uint8)
    for at in range(0, len(raw), 1 << 20):
        seen += np.bincount(whole[at : at + (1 << 20)], minlength=256)
    continued = int(seen[0x80:0xC0].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    # letters of all scripts: the few that are not ASCII are counted by kind
    others = Counter("".join(_OTHERS.findall(text))) if continued else {}
    ends, symbols, odd, loud, capitals = _by_word(whole, seen)
    return (
        len(words),
        len(raw) - continued - int(seen[9:14].sum() + seen[32]),
        int(seen[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        _repeated(ids, len(index)),
        len(lines),
        int(seen[65:91].sum()) + sum(n for c, n in others.items() if c != c.lower()),
        int(seen[97:123].sum()) + sum(n for c, n in others.items() if c != c.upper()),
        int(seen[[33, 63]].sum()),
        ends,
        symbols,
        odd,
        len(index),
        loud,
        capitals,
    )


def with_features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with the columns of FEATURES; columns of those names are replaced."""
    return with_columns(docs, text, FEATURES, lambda: features_of, keep)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(F.col("n_words") == 0, -1).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules' votes over the columns of FEATURES. No rule yields null.

    The rules are strict and wrong many good texts each; that is what their votes
    are weighed for.
    """
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    share = lambda c: F.col(c) / words
    upper = F.col("n_upper") / F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    mean, copied = F.col("word_chars") / words, F.col("n_dup_lines") / lines
    variety = F.log(F.col("n_distinct") + 1) / F.log(words + 1)  # hardly depends on a text's length
    return {
        "few_symbols": _vote(share("n_symbols") < 0.02, share("n_symbols") > 0.1),
        "clean_words": _vote(share("n_symbol_words") < 0.02, share("n_symbol_words") > 0.05),
        "plain_ends": _vote(share("n_odd_ends") < 0.01, share("n_odd_ends") > 0.05),
        "few_repeats": _vote(share("n_repeat_words") < 0.08, share("n_repeat_words") > 0.16),
        "varied_words": _vote(variety > 0.9, variety < 0.85),
        "few_copied_lines": _vote(copied == 0, copied > 0.05),
        "lower_case": _vote(upper < 0.05, upper > 0.15),
        "few_marks": _vote(share("n_marks") < 0.03, share("n_marks") > 0.1),
        "calm_words": _vote(share("n_loud_words") < 0.01, share("n_loud_words") > 0.05),
        "few_capitals": _vote(share("n_upper_words") < 0.02, share("n_upper_words") > 0.08),
        "sentences": _vote(share("n_ends").between(0.03, 0.2), ~share("n_ends").between(0.015, 0.3)),
        "word_length": _vote(mean.between(3.5, 8.0), ~mean.between(3.0, 10.0)),
        "long_enough": _vote(F.col("n_words") >= 80, F.col("n_words") < 50),
    }


#: The rules that look at one kind of bad text by different signs.
FAMILIES = (
    ("few_symbols", "clean_words", "plain_ends"),
    ("few_repeats", "varied_words", "few_copied_lines"),
    ("lower_case", "few_marks", "calm_words", "few_capitals", "sentences"),
    ("word_length", "long_enough"),
)


@dataclass(frozen=True)
class LabelModel:
    """Shares of the classes and the chances of each vote by class.

    The first class is that of good texts; the others are kinds of bad ones, one
    a family. chances[class][rule] holds the chances that the rule, where it
    votes, votes -1 or 1; between them stands 1 for abstaining, which says
    nothing about a text.
    """

    names: tuple[str, ...]
    shares: tuple[float, ...]
    chances: tuple[tuple[tuple[float, float, float], ...], ...]
    families: tuple[tuple[str, ...], ...]

    def accuracy(self) -> dict[str, float]:
        """The chance that a rule is right when it votes on a good text or on a bad one of its own family."""
        share, chance = np.array(self.shares), np.array(self.chances)
        own = {name: 1 + k for k, family in enumerate(self.families) for name in family}
        out = {}
        for j, name in enumerate(self.names):
            at = [0, own[name]]
            right = share[0] * chance[0, j, 2] + share[at[1]] * chance[at[1], j, 0]
            out[name] = float(right / share[at].sum())
        return out

    def posterior(self, votes: dict[str, Column]) -> Column:
        """P(good | votes)."""
        tables = [[float(np.log(x)) for chance in chances for x in chance] for chances in self.chances]
        cast = F.array(*(F.struct(F.lit(float(np.log(share))).alias("share"), F.array(*map(F.lit, table)).alias("table")) for share, table in zip(self.shares, tables)))
        # where the rule's vote stands in a class's table; arrays keep the generated code small
        places = F.array(*(votes[name] + (3 * j + 1) for j, name in enumerate(self.names)))
        weight = lambda c: F.aggregate(places, c["share"], lambda acc, at: acc + F.get(c["table"], at))
        both = F.transform(F.array(F.transform(cast, weight)), lambda w: F.aggregate(w, F.lit(0.0), lambda acc, x: acc + F.exp(x - F.get(w, F.lit(0)))))
        return 1 / both[0]


def estimate(patterns: np.ndarray, counts: np.ndarray, names: list[str], families: Sequence[Sequence[str]] | None = None, rounds: int = 500, tol: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and their counts.

    Bad texts are bad in different ways that seldom fail the same rules, so each
    family of rules begins a class of bad texts of its own; the good texts are
    one class. Before any text is seen, votes are thought right THOUGHT of the
    time among good texts and in the family's own class, and either way
    elsewhere; that is worth WORTH texts, whatever the corpus holds. All else
    comes from which votes agree: a sign whose bad votes the rest of its family
    contradicts becomes one that is often wrong.
    """
    families = families or [(name,) for name in names]  # by default each rule is a family of its own
    n, total = len(names), float(counts.sum())
    shown = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)  # pattern, rule, vote
    shown[:, :, 1] = 0  # abstentions count for no class
    own = np.array([[name in family for name in names] for family in families], float)  # family, rule
    prior = np.zeros((len(families) + 1, n, 3))
    prior[:, :, 0] = prior[:, :, 2] = WORTH / 10  # elsewhere
    prior[0] = WORTH * np.array([1 - THOUGHT, 0, THOUGHT])
    prior[1:] = np.where(own[:, :, None] > 0, WORTH * np.array([THOUGHT, 0, 1 - THOUGHT]), prior[1:])
    against = (patterns == -1).astype(float)
    part = against @ own.T / own.sum(1)  # how much of each family votes bad
    bad = part.max(1, keepdims=True, initial=0)
    member = np.hstack([1 - bad, bad * part / np.maximum(part.sum(1, keepdims=True), 1e-9)])
    for _ in range(rounds):
        mass = counts[:, None] * member
        shares = (mass.sum(0) + 1) / (total + len(families) + 1)
        chance = np.einsum("pc,pjv->cjv", mass, shown) + prior
        chance = chance / chance.sum(2, keepdims=True)
        chance[:, :, 1] = 1
        weight = np.log(shares) + np.einsum("pjv,cjv->pc", shown, np.log(chance))
        new = np.exp(weight - weight.max(1, keepdims=True, initial=-np.inf)) if len(weight) else weight
        new = new / new.sum(1, keepdims=True)
        moved = float(np.abs(new - member).max(initial=0))
        member = new
        if moved < tol:
            break
    return LabelModel(tuple(names), tuple(map(float, shares)), tuple(tuple(tuple(map(float, v)) for v in c) for c in chance), tuple(map(tuple, families)))


def fit(features: DataFrame) -> LabelModel:
    """The label model from all rows of a table with the columns of FEATURES."""
    votes = rules()
    names = list(votes)
    rows = features.groupBy(*(votes[n].alias(n) for n in names)).agg(F.count(F.lit(1)).alias("n")).collect()
    rows.sort(key=lambda r: [r[n] for n in names])
    return estimate(np.array([[r[n] for n in names] for r in rows], float).reshape(-1, len(names)), np.array([r["n"] for r in rows], float), names, FAMILIES)


def base_failed() -> Column:
    """Fewer than 10 words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judged(features: DataFrame, model: LabelModel, threshold: float = 0.5) -> DataFrame:
    """features with base_failed, quality (the posterior) and kept."""
    return (
        features.withColumn("base_failed", base_failed())
        .withColumn("quality", model.posterior(rules()))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def _figured(docs: DataFrame, text: str) -> tuple[DataFrame, LabelModel, list[Column]]:
    """docs as written with the figures beside aside()'s columns, the model fitted on them, and what selects docs' columns back.

    Figures cost far more than a write of the texts they are made from, so they
    are made once; the fit reads their columns alone.
    """
    moved, back = aside(docs)  # so that no column of docs is taken for a figure or verdict
    rows = written(with_features(moved, placed(docs, text)), "quality-rows")
    return rows, fit(rows), back


def only_kept(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs that the posterior keeps, with docs' columns as they are, whatever their names.

    Every row is judged by its text alone: a null doc_id, a repeated one or a
    null in any other column changes nothing, repeated rows all stay or all go.
    No join or shuffle moves texts.
    """
    rows, model, back = _figured(docs, text)
    return judged(rows, model, threshold).where("kept").select(*back)


def posteriors(docs: DataFrame, text: str = "text", out: str = "quality", words: str | None = None) -> DataFrame:
    """docs with the posterior probability that each text is good in the column out and, if words names a column, the number of words in that.

    Columns of docs with these names are replaced.
    """
    rows, model, back = _figured(docs, text)
    keep = [c for c, name in zip(back, docs.columns) if name.lower() not in {out.lower(), (words or out).lower()}]
    weighed = rows.withColumn("__posterior", model.posterior(rules())).withColumn("__size", F.col("n_words"))
    return weighed.select(*keep, F.col("__posterior").alias(out), *([F.col("__size").alias(words)] if words else []))


def figures_with_posterior(docs: DataFrame, text: str = "text", keep: Sequence[str] = (), out: str = "quality") -> DataFrame:
    """The columns in keep, the text's xxhash64 in place of the text itself, the figures, and the posterior in the column out.

    The texts are read once: the figures are written, and verdicts made from them.
    """
    marked = docs.select(*(F.col(f"`{c}`") for c in keep), F.xxhash64(f"`{text}`").alias(f"{text}_hash"), F.col(f"`{text}`"))
    features = written(with_features(marked, text, keep=[*keep, f"{text}_hash"]), "quality-features")
    return features.withColumn(out, fit(features).posterior(rules()))
