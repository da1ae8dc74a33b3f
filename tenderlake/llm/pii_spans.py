"""Personal data in texts, with DataFrame functions only.

Generators propose spans: fixed formats (e-mail, IP address, payment card,
international phone), which always stay, and high-recall ones (numbers of seven
digits and more in any grouping, spelled-out addresses, account numbers), which
mostly propose nothing of interest. Gradient-boosted trees score the latter from
their format and from the words around them. Scores are calibrated, and a
threshold is selected for each kind, on examples of other formats and wordings
than those that the trees are fitted on.

The trees are fitted on three kinds of rows, some thousand at most whatever the
corpus holds: personal data and look-alikes made from templates, both set amid
contexts of the corpus, and a sample of the corpus' own candidates (SAMPLE, the
smallest by a hash), which count as no personal data unless the words before
them say so. Features of all come from the same column expressions as those of
the texts. The trees are evaluated as CASE expressions, so scoring runs wholly in
the JVM.

Null and empty texts have no spans; rows that are alike are treated alike; very
long texts are looked through as a whole; other columns, whatever their names,
are left alone, but base and added are replaced. An empty table gives an empty
result.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which they are listed at one start.
KINDS = ("email", "ip", "card", "phone", "digits", "spelled", "account")
BASE = 4

# Possessive forms of the plain patterns: a run is entered at its first character
# or where the last match ended, so no text takes time beyond its length.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Generators of no fixed length: groups of digits with marks between them, and so on. The look-behinds refuse what goes on from a word or number.
DIGITS = r"(?<![0-9A-Za-z+]|[0-9][.,])\(?[0-9]++\)?+(?:[\x20/.-]{1,2}\(?[0-9]++\)?+)*+(?![0-9A-Za-z])"
SPELLED = r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++\x20?+(?:\(at\)|\[at\]|(?<=\x20)at(?=\x20))\x20?+[a-z0-9-]++(?:\x20?+(?:\(dot\)|\[dot\]|(?<=\x20)dot(?=\x20))\x20?+[a-z0-9-]++)+(?![a-z0-9])"
ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,}+(?:\x20?[A-Z0-9]{1,3})?+(?![0-9A-Za-z])"
#: Digits that a number must have to be proposed: fewer make no phone, account or identity number.
LEAST_DIGITS = 7
#: Candidates of the corpus that the trees are fitted on, at most; positions of the corpus that give contexts to templates.
SAMPLE, CONTEXTS = 1500, 200
PRECISION = 0.95

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
CHUNK = 256


def matches(text: Column, pattern: str) -> Column:
    """The pattern's matches as array<struct<start, end, text, before, after>>, from 0 in code points.

    The pieces between the matches give both their places and their context.
    Running sums go chunk by chunk, so texts with very many matches stay cheap.
    """
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    whole = F.struct(pieces.alias("p"), found.alias("m"))
    # one evaluation of each: a let-binding by way of a one-element transform
    return F.flatten(F.transform(F.array(whole), lambda w: _placed(w["p"], w["m"])))


def _placed(pieces: Column, found: Column) -> Column:
    n = F.size(found)
    empty = "array<struct<start:int,end:int,text:string,before:string,after:string>>"

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(pieces, i))
        end = start + F.length(F.get(found, i))
        one = F.struct(start.alias("start"), end.alias("end"), F.get(found, i).alias("text"), F.right(F.get(pieces, i), F.lit(32)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(8)).alias("after"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

    def chunk(acc: Column, c: Column) -> Column:
        zero = F.struct(acc["at"].alias("at"), F.array().cast(empty).alias("out"))
        inner = F.aggregate(F.sequence(c, F.least(c + (CHUNK - 1), n - 1)), zero, step)
        return F.flatten(F.transform(F.array(inner), lambda x: F.array(F.struct(x["at"].alias("at"), F.concat(acc["out"], x["out"]).alias("out")))))[0]

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(empty).alias("out"))
    made = F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(CHUNK)), zero, chunk, lambda acc: acc["out"])
    return F.when(n > 0, made).otherwise(F.array().cast(empty))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _spans(text: Column, applies: Column, pattern: str, kind: str, valid=None) -> Column:
    """Spans of one kind; the pattern is tried only where it can match."""
    all_of = matches(text, pattern)
    kept = F.filter(all_of, valid) if valid else all_of
    number = F.lit(KINDS.index(kind)).alias("kind")
    made = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), number, x["end"].alias("end")))
    return F.coalesce(F.when(applies, made), F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def base_spans(text: Column) -> list[Column]:
    """For each fixed format an array<struct<start, kind, end>>."""
    size = lambda x: F.length(digits_of(x["text"]))
    return [
        _spans(text, F.contains(text, F.lit("@")), EMAIL, "email"),
        _spans(text, text.rlike(r"[0-9]\.[0-9]"), IP, "ip", lambda x: x["text"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        _spans(text, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), CARD, "card", lambda x: F.when(size(x).between(12, 19), luhn(digits_of(x["text"]))).otherwise(False)),
        _spans(text, F.contains(text, F.lit("+")), PHONE, "phone", lambda x: size(x).between(9, 15)),
    ]


FEATURES = (
    "kind", "n_digits", "n_groups", "last_group", "first_group", "parens", "slashes", "dashes", "dots", "spaces", "us_phone", "national_id", "date", "passes_luhn",
    "says_phone", "says_id", "says_count", "says_mail", "before_joined", "after_joined",
)


def features(x: Column, kind: int) -> list[Column]:
    """The features of a proposed span, each a whole number."""
    t, before = x["text"], F.lower(x["before"])
    flag = lambda c: F.when(c, 1).otherwise(0)
    times = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    digits = digits_of(t)
    return [
        F.lit(kind),
        F.length(digits),
        F.size(F.split(t, r"[\x20/().-]+")),
        F.length(F.regexp_extract(t, "[0-9]*$", 0)),
        F.length(F.regexp_extract(t, "^[0-9(]*", 0)),
        flag(F.contains(t, F.lit("("))),
        times("/"), times("-"), times("."), times(" "),
        flag(t.rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$")),
        flag(t.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")),
        flag(t.rlike(r"^(?:(?:19|20)[0-9]{2}[/.-][0-9]{1,2}[/.-][0-9]{1,2}|[0-9]{1,2}[/.-][0-9]{1,2}[/.-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-(?:19|20)?[0-9]{2})$")),
        flag(F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)),
        flag(before.rlike(PHONE_WORDS)),
        flag(before.rlike(ID_WORDS)),
        flag(before.rlike(COUNT_WORDS)),
        flag(before.rlike(r"(?:mail|contact|write|reach|address|schreib|kontakt|écri|escrib|correo)[\p{L}]*\W{0,3}(?:\w+\W{1,3}){0,2}$")),
        flag(before.rlike(r"[\p{L}\p{N}$€£]$")),
        flag(x["after"].rlike(r"^[\p{L}\p{N}%€]")),
    ]


PHONE_WORDS = r"(?:phone|tel|mobile|cell|call|fax|whatsapp|sms|ring|dial|teléfono|telefono|móvil|llame|téléphone|appel|portable|telefon|handy|anruf)[\p{L}]*\W{0,3}(?:\w+\W{1,3}){0,2}$"
ID_WORDS = r"(?:ssn|social security|passport|tax id|national id|cédula|nit|dni|iban|account|konto|compte|cuenta|ausweis|reisepass|passeport|licence|license|steuer)[\p{L}]*\W{0,3}(?:\w+\W{1,3}){0,2}$"
COUNT_WORDS = r"(?:order|invoice|pages?|isbn|issn|doi|version|release|years?|between|from|total|sum|part|serial|model|build|tracking|ticket|population|distance|rechnung|seiten|facture|página|no\.?|nr\.?|n°|#|\$|€|£)\W{0,3}$"


def examples(n: int = 300, seed: int = 5, unlike: bool = False) -> list[tuple[int, str, str, str, int]]:
    """Labelled candidates from templates: kind, text, before, after, 1 for personal data.

    unlike gives other formats and wordings, which nothing is fitted on: scores
    are calibrated and thresholds selected there.
    """
    rng, out = random.Random(seed), []
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8)))
    plain = lambda: f" {word()} {word()} "
    us = lambda: f"{rng.choice('23456789')}{num(2)}"
    pick = rng.choice
    if not unlike:
        phone, ident, mail = ("phone: ", "call me at ", "Tel. ", "mobile ", "Telefon: "), ("SSN ", "passport no. ", "tax id: ", "IBAN: ", "Konto "), ("mail me: ", "contact ", "write to ", "reach me on ")
        count = ("order ", "invoice no. ", "pages ", "serial ", "between ", "total ", "# ")
        good = lambda: [
            (4, pick((f"({(a := us())}) {num(3)}-{num(4)}", f"{a}-{num(3)}-{num(4)}", f"{a}.{num(3)}.{num(4)}")), pick((*phone, plain()))),
            (4, f"{num(3)} {num(2)} {num(2)} {num(2)}", pick(phone)),
            (4, f"0{num(rng.randint(8, 10))}", pick(phone)),
            (4, f"{num(3)}-{num(2)}-{num(4)}", pick((*ident, plain()))),
            (4, f"{num(rng.randint(8, 10))}", pick(ident)),
            (5, f"{word()} (at) {word()} (dot) com", pick((*mail, plain()))),
            (5, f"{word()}[at]{word()}[dot]org", pick((*mail, plain()))),
            (5, f"{word()} at {word()} dot com", pick(mail)),
            (6, f"DE{num(2)} {num(4)} {num(4)} {num(4)} {num(4)} {num(2)}", pick((*ident, plain()))),
            (6, f"FR{num(2)}{num(20)}{pick('ABC')}{num(2)}", pick(ident)),
        ]
        bad = lambda: [
            (4, pick((f"20{num(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/19{num(2)}")), plain()),
            (4, f"19{num(2)}-19{num(2)}", pick((*count, plain()))),
            (4, f"{num(rng.randint(3, 6))} {num(rng.randint(4, 6))}", pick((*count, plain()))),
            (4, f"{num(2)} {num(3)} {num(3)}", pick((*count, " $", plain()))),
            (4, f"{num(rng.randint(7, 18))}", pick((*count, plain()))),
            (4, f"{num(4)}/{num(4)}", plain()),
            (4, f"{num(2)}.{num(3)}.{num(3)}", plain()),
            (5, f"{word()} at {word()} dot {word()}", plain()),
            (6, f"{pick('ABC')}{pick('XYZ')}{num(2)} {num(4)} {num(4)}", pick(count)),
        ]
    else:
        phone, ident, mail = ("ring ", "my cell is ", "Handy ", "móvil: ", "portable : ", "fax "), ("account number ", "cédula ", "compte ", "DNI: ", "licence no "), ("e-mail: ", "schreib an ", "correo: ")
        count = ("ISBN ", "ticket ", "build ", "model ", "version ", "population ", "tracking ")
        good = lambda: [
            (4, f"{us()} {num(3)} {num(4)}", pick((*phone, plain()))),
            (4, f"0{num(1)}.{num(2)}.{num(2)}.{num(2)}.{num(2)}", pick(phone)),
            (4, f"0{num(3)}/{num(6)}", pick(phone)),
            (4, f"{num(9)}", pick(ident)),
            (4, f"{num(2)}.{num(3)}.{num(3)}-{num(1)}", pick(ident)),
            (5, f"{word()}.{word()} [at] {word()} [dot] net", pick((*mail, plain()))),
            (5, f"{word()}(at){word()}(dot)co(dot)uk", pick((*mail, plain()))),
            (6, f"GB{num(2)} WEST {num(4)} {num(4)} {num(4)} {num(2)}", pick((*ident, plain()))),
            (6, f"ES{num(22)}", pick(ident)),
        ]
        bad = lambda: [
            (4, f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}", pick((*count, plain()))),
            (4, f"{rng.randint(1, 9)}.{rng.randint(10, 99)}.{num(4)}", pick(count)),
            (4, f"{num(8)}", pick((*count, plain()))),
            (4, f"{num(16)}", plain()),
            (4, f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.20{num(2)}", plain()),
            (4, f"{num(1)} {num(3)} {num(3)}", pick((*count, plain()))),
            (5, f"{word()} at {word()} dot {word()}", plain()),
            (6, f"{pick('PQR')}{pick('XYZ')}{num(2)}{num(4)}{num(4)}", pick(count)),
        ]
    for _ in range(n):
        for label, (kind, text, before) in ((1, pick(good())), (0, pick(bad()))):
            out.append((kind, text, before, pick((" ", ".", ", ", "")), label))
    return out


@dataclass(frozen=True)
class Boosted:
    """Trees of depth two with calibrated output, and the threshold of each kind."""

    trees: tuple = field(default_factory=tuple)
    scale: float = 1.0
    shift: float = 0.0
    thresholds: tuple = field(default_factory=tuple)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for (f, t), (low, high) in self.trees:
            for side, ((g, u), a, b) in ((x[:, f] <= t, low), (x[:, f] > t, high)):
                total += np.where(side, np.where(x[:, g] <= u, a, b), 0)
        return total

    def score(self, x: list[Column]) -> Column:
        """The calibrated probability as a column."""
        total = F.lit(0.0)
        for (f, t), (low, high) in self.trees:
            leaf = lambda side: F.when(x[side[0][0]] <= side[0][1], side[1]).otherwise(side[2])
            total = total + F.when(x[f] <= t, leaf(low)).otherwise(leaf(high))
        return 1 / (1 + F.exp(-(total * self.scale + self.shift)))


def _best_split(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[int, float, float, float]:
    """Feature, threshold and both leaf values of the split with the largest gain."""
    value = lambda m: float(gradient[m].sum() / (weight[m].sum() + 1.0))
    best = (-1.0, 0, 0.5, value(np.ones(len(x), bool)), value(np.ones(len(x), bool)))
    for f in range(x.shape[1]):
        for t in np.unique(x[:, f])[:-1] + 0.5:
            low = x[:, f] <= t
            gain = sum(gradient[m].sum() ** 2 / (weight[m].sum() + 1.0) for m in (low, ~low))
            if gain > best[0] + 1e-9:
                best = (gain, f, float(t), value(low), value(~low))
    return best[1:]


def boost(x: np.ndarray, y: np.ndarray, other: np.ndarray, answers: np.ndarray, rounds: int = 40, rate: float = 0.3, precision: float = PRECISION) -> Boosted:
    """Fit on x and y; calibrate and select thresholds on other rows and their answers.

    A kind's threshold is the lowest score at which what scores as much and more
    has the precision; with none it is above all scores there.
    """
    trees, total = [], np.zeros(len(x))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        f, t, _, _ = _best_split(x, y - p, p * (1 - p))
        sides = []
        for side in (x[:, f] <= t, x[:, f] > t):
            if side.any():
                g, u, a, b = _best_split(x[side], (y - p)[side], (p * (1 - p))[side])
            else:
                g, u, a, b = 0, 0.5, 0.0, 0.0
            sides.append(((g, u), rate * a, rate * b))
        trees.append(((f, t), tuple(sides)))
        total = total + Boosted((trees[-1],)).raw(x)
    raw = Boosted(tuple(trees)).raw(other)
    unit, scale, shift = max(float(raw.std()), 1e-6), 1.0, 0.0
    for _ in range(1000):  # Platt's two parameters by gradient descent on standardised scores
        error = 1 / (1 + np.exp(-(raw / unit * scale + shift))) - answers
        scale, shift = scale - 0.5 * float((error * raw / unit).mean()), shift - 0.5 * float(error.mean())
    scale /= unit
    p, thresholds = 1 / (1 + np.exp(-(raw * scale + shift))), []
    for kind in range(BASE, len(KINDS)):
        mine = other[:, 0] == kind
        score, truth = p[mine], answers[mine]
        levels = sorted({float(v) for v in score if truth[score >= v].mean() >= precision})
        # halfway to the next lower score, so that rounding decides nothing
        low = max((v for v in score if levels and v < levels[0]), default=0.0)
        thresholds.append((levels[0] + float(low)) / 2 if levels else 1.0)
    return Boosted(tuple(trees), scale, shift, tuple(thresholds))


def _generators(text: Column) -> dict[str, tuple[Column, str, object]]:
    """For each high-recall kind where it can apply, its pattern, and what a match must be to be proposed."""
    return {
        "digits": (text.rlike(r"[0-9](?:[\x20/.()-]{0,3}[0-9]){6}"), DIGITS, lambda x: F.length(digits_of(x["text"])) >= LEAST_DIGITS),
        "spelled": (text.rlike(r"(?i)[(\[\x20]at[)\]\x20]") & text.rlike(r"(?i)[(\[\x20]dot[)\]\x20]"), SPELLED, None),
        "account": (text.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"), ACCOUNT, None),
    }


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """kind, text, before and after: all that the high-recall generators propose apart from spans of fixed formats."""
    t = F.col(f"`{text}`")
    shape = "array<struct<kind:int,start:int,end:int,text:string,before:string,after:string>>"
    found = []
    for kind, (applies, pattern, valid) in _generators(t).items():
        all_of = matches(t, pattern)
        number = F.lit(KINDS.index(kind)).alias("kind")
        made = F.transform(F.filter(all_of, valid) if valid else all_of, lambda x: F.struct(number, x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"), x["before"].alias("before"), x["after"].alias("after")))
        found.append(F.coalesce(F.when(applies, made), F.array().cast(shape)))
    both = docs.select(F.concat(*found).alias("found"), t.alias("t")).where(F.size("found") > 0).select("found", F.concat(*base_spans(F.col("t"))).alias("base"))
    apart = F.filter("found", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return both.select(F.explode(apart).alias("x")).select("x.kind", "x.text", "x.before", "x.after")


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Boosted:
    """The trees for a corpus, from templates amid its contexts and a sample of its own candidates.

    Of its candidates those with the smallest hashes are taken, as many as
    sample; those with words of phones or identities before them are left out,
    as nobody has said what they are.
    """
    spark = docs.sparkSession
    proposed = candidates(docs, text).where(~F.lower("before").rlike(PHONE_WORDS) & ~F.lower("before").rlike(ID_WORDS))
    own = proposed.orderBy(F.xxhash64("kind", "text", "before", "after"), "kind", "text", "before", "after").limit(sample).collect()
    contexts = [r.before[:-1] for r in own[:CONTEXTS] if r.before]
    rng = random.Random(11)
    amid = lambda before: (rng.choice(contexts)[-16:] + " " if contexts and rng.random() < 0.5 else "") + before.lstrip()
    said = [(k, t, amid(b), a, y, 0) for k, t, b, a, y in examples(400, 5)] + [(r.kind, r.text, r.before, r.after, 0, 0) for r in own]
    said += [(k, t, amid(b), a, y, 1) for k, t, b, a, y in examples(300, 6, unlike=True)]
    names = ("i", "kind", "text", "before", "after", "y", "held")
    told = F.from_json(F.lit(json.dumps([dict(zip(names, (i, *r))) for i, r in enumerate(said)])), "array<struct<i:int,kind:int,text:string,before:string,after:string,y:int,held:int>>")
    rows = spark.range(1).select(F.explode(told).alias("r")).select("r.*")
    one = features(F.struct("text", "before", "after"), 0)[1:]
    got = rows.select("i", "kind", "y", "held", *(c.alias(n) for n, c in zip(FEATURES[1:], one))).orderBy("i").collect()
    matrix, truth, held = np.array([[r[n] for n in FEATURES] for r in got], float), np.array([r["y"] for r in got], float), np.array([r["held"] for r in got]) == 1
    return boost(matrix[~held], truth[~held], matrix[held], truth[held])


def _both(valid, test):
    """A condition on a match that is tried only where another holds."""
    return (lambda x: F.when(valid(x), test(x)).otherwise(False)) if valid else test


def proposed_spans(text: Column, trees: Boosted) -> list[Column]:
    """For each high-recall generator the spans that the trees accept."""

    def accepted(kind: int):
        def test(x: Column) -> Column:
            named = F.transform(F.array(F.struct(*(c.alias(n) for n, c in zip(FEATURES, features(x, kind))))), lambda f: trees.score([f[n] for n in FEATURES]))
            return named[0] >= trees.thresholds[kind - BASE]

        return test

    made = []
    for kind, (applies, pattern, valid) in _generators(text).items():
        made.append(_spans(text, applies, pattern, kind, _both(valid, accepted(KINDS.index(kind)))))
    return made


def _said(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, text: str = "text", trees: Boosted | None = None) -> DataFrame:
    """docs with base, an array of the fixed formats' spans, and added, of those that the trees accept.

    Spans are struct<start, kind, end>: code points, end exclusive, kind a place
    in KINDS. Both arrays are sorted by start and kind and empty for null and
    empty texts. An accepted span that overlaps a fixed format's is left out; of
    accepted spans that overlap each other the longest stays, then the first.
    Columns base and added of docs are replaced. Without trees they are fitted
    on docs.
    """
    trees, t = trees or fit(docs, text), F.col(f"`{text}`")
    kept = [c for c in docs.columns if c not in ("base", "added")]
    found = docs.select(*(F.col(f"`{c}`") for c in kept), F.array_sort(F.concat(*base_spans(t))).alias("base"), F.array_sort(F.concat(*proposed_spans(t, trees))).alias("added"))
    apart = F.filter("added", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    found = found.withColumn("added", F.when(F.size("base") > 0, apart).otherwise(F.col("added")))
    return found.withColumn("added", F.when(F.size("added") > 1, _longest(F.col("added"))).otherwise(F.col("added")))


def _longest(spans: Column) -> Column:
    """Of spans that overlap the longest, then the first; taken one by one, so a span gives way only to one that stays."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct((s["start"] - s["end"]).alias("less"), s.alias("s"))))
    clear = lambda kept, s: ~F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
    kept = F.aggregate(ordered, F.slice(spans, 1, 0), lambda kept, x: F.when(clear(kept, x["s"]), F.concat(kept, F.array(x["s"]))).otherwise(kept))
    return F.array_sort(kept)


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trees: Boosted | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans for every row."""
    found = find(docs.select(F.col(doc_id), F.col(text)), text, trees)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(doc_id, *map(count, range(BASE)), F.sha2(_said(F.col("base")), 256).alias("base_sha256"), _said(F.array_sort(F.concat("base", "added"))).alias("spans"))
