"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the spans of strict patterns, which always stay, and of looser
ones: mail addresses with their signs spelled out, IPv6 addresses, shorter cards,
account numbers with right check digits (IBAN, of kind card), phone numbers
without a country code.  Labelers vote on each candidate (1 personal, -1 not, 0
no opinion): the strict pattern, a check of its digits or parts, gazetteers of
issuers, account countries, numbering plans, domains and networks, a gazetteer of
people's names and of posts, words around it, the characters that touch it, and
the form of looser ones.  Expectation-maximisation over the counts of all vote
patterns estimates how reliable each labeler is.  The resulting probabilities of
the looser candidates train a naive Bayes classifier of their surface features,
which together with the votes decides on them.

Matches have no positions in Spark SQL, so a text is both split by a pattern and
searched for it: the lengths of the parts and matches add up to the positions.
Patterns are written without repeated groups and without overlapping starts, so
that long runs neither recurse nor take quadratic time.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import ensure_checkpoint_dir

#: Kinds in the order of reports.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# Strict patterns.  U+E000 stands for one separator between digits and U+E002
# for a dot that no domain label follows; both keep all positions.
STRICT_EMAIL = "(?:(?<![A-Za-z0-9._%+\ue002-])|\\G)[A-Za-z0-9._%+\ue002-]++@[A-Za-z0-9-]++\\.[A-Za-z0-9-][A-Za-z0-9.-]*+"
STRICT_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
STRICT_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
DIGIT_RUN = "(?<![0-9\ue000])[0-9][0-9\ue000]{12,36}(?![0-9\ue000])"
# Looser patterns.
AT, DOT = r" ?[\[({](?i:at)[\])}] ?", r"(?: ?[\[({](?i:dot)[\])}] ?| (?i:dot) |\.)"
LABEL = r"[A-Za-z0-9-]++"
LOOSE_EMAIL = (
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:{AT}{LABEL}(?:{DOT}{LABEL}){{0,2}}{DOT}"
    rf"| (?i:at) {LABEL}(?: (?i:dot) {LABEL}){{0,2}} (?i:dot) )[A-Za-z]{{2,}}+"
)
LOOSE_IP = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
LOOSE_PHONE = (
    r"(?<![0-9+.-])(?:(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"|0[1-9](?:[ .][0-9]{2}){4}"
    r"|(?:\(0[1-9][0-9]{1,3}\)|0[1-9][0-9]{1,3})[ /-][0-9]{3,4}[ -]?[0-9]{3,4})(?![0-9-])"
)
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"

OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
# Gazetteers.
#: Endings of domains in common use.
DOMAINS = (
    "com org net edu gov mil int info biz name io co app dev ai me tv xyz online site shop cloud tech "
    "ar at au be bg br ca ch cl cn cz de dk ee es eu fi fr gr hk hr hu id ie il in is it jp kr lt lu lv mx my "
    "nl no nz pe ph pk pl pt ro rs ru se sg si sk th tr tw ua uk us uy vn za"
).split()
#: Card numbers by their first six digits: least, greatest, numbers of digits.
ISSUERS = (
    (400000, 499999, 13, 19), (510000, 559999, 16, 16), (222100, 272099, 16, 16), (340000, 349999, 15, 15), (370000, 379999, 15, 15),
    (300000, 305999, 14, 19), (360000, 369999, 14, 19), (380000, 399999, 14, 19), (601100, 601199, 16, 19), (644000, 659999, 16, 19),
    (352800, 358999, 16, 19), (620000, 629999, 16, 19), (560000, 589999, 12, 19), (630000, 639999, 12, 19),
)
#: Characters of account numbers by country.
ACCOUNTS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}
#: Numbering plans: country code, least and greatest number of digits after it.
PLANS = (
    ("1", 10, 10), ("7", 10, 10), ("20", 8, 10), ("27", 9, 9), ("30", 10, 10), ("31", 9, 9), ("32", 8, 9), ("33", 9, 9), ("34", 9, 9),
    ("36", 8, 9), ("39", 6, 11), ("40", 9, 9), ("41", 9, 9), ("43", 7, 13), ("44", 9, 10), ("45", 8, 8), ("46", 7, 10), ("47", 8, 8),
    ("48", 9, 9), ("49", 6, 11), ("51", 8, 9), ("52", 10, 10), ("54", 10, 11), ("55", 10, 11), ("56", 9, 9), ("57", 8, 10), ("60", 8, 10),
    ("61", 9, 9), ("62", 8, 12), ("63", 8, 10), ("64", 8, 10), ("65", 8, 8), ("66", 8, 9), ("81", 9, 10), ("82", 8, 10), ("84", 9, 10),
    ("86", 10, 11), ("90", 10, 10), ("91", 10, 10), ("92", 9, 10), ("351", 9, 9), ("353", 7, 9), ("358", 6, 11), ("380", 9, 9), ("420", 9, 9),
)
#: Given names, and posts that no single person holds.
NAMES = (
    "james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph jessica thomas sarah "
    "charles karen daniel nancy matthew lisa anthony betty mark margaret paul sandra andrew ashley anna peter maria hans jane jean marie "
    "pierre carlos juan jose luis ana sofia giulia marco luca ahmed fatima mohammed wei li yuki kenji olga ivan emma olivia noah"
).split()
POSTS = "info support sales admin webmaster noreply no-reply contact office help postmaster abuse hello news newsletter service team jobs press billing".split()
NO_ONES_NETWORK = r"(?i)^(?:(?:0|127|255|22[4-9]|23[0-9])\.|0{1,4}:|f[ef][0-9a-f]{2}:|2001:0?db8:)"
# Context words.
NEAR = (
    r"(?i)\b(?:e-?mail|mail|write|contact|reach)\b|@",
    r"(?i)\b(?:ip|host|server|login|address|client|from)\b",
    r"(?i)\b(?:card|visa|mastercard|amex|payment|paid|credit|debit|iban|account|konto|bank)\b",
    r"(?i)\b(?:phone|tel|telephone|telefon|call|fax|mobile|cell|whatsapp|sms|dial|ring)\b",
)
AGAINST = r"(?i)\b(?:version|isbn|issn|order|invoice|sku|serial|build|release|figure|table|section|chapter|item|part|ticket|doi)\b(?: (?:no|nr|number|id))?[ :#.]*$"

LABELERS = 7
ITERATIONS = 12
#: Chances to start from: that a strict and a looser candidate is personal; that each
#: labeler's vote is a yes for personal and for other spans.
STRICT_PRIOR, LOOSE_PRIOR = 0.8, 0.3
YES_PERSONAL = (0.85, 0.95, 0.85, 0.8, 0.9, 0.7, 0.6)
YES_OTHER = (0.35, 0.35, 0.4, 0.4, 0.2, 0.25, 0.35)
#: Candidates that these chances count for in the estimates.
STRENGTH = 10
#: Characters around a span that labelers see.
LEFT, RIGHT = 32, 12


def spans(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their places: array of (start, end, text), code points."""
    parts = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.slice(F.zip_with(parts, matches, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("text"))), F.lit(1), F.size(matches))
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["text"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["text"].alias("text")))).alias("out"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), step) % 10 == 0


def candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` and a column ``candidates``: (kind, start, end, base, text, left, right)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    empty = F.array().cast("array<struct<start:int,end:int,text:string>>")

    def found(needs: Column, pattern: str, of: Column | None = None) -> Column:
        return F.when(needs, spans(text if of is None else of, pattern)).otherwise(empty)

    number = text.rlike("[0-9]")
    marked = F.regexp_replace(F.translate(text, "\ue002", "\ue003"), r"\.(?![A-Za-z0-9-])", "\ue002")
    joined = F.regexp_replace(F.translate(text, "\ue000", "\ue001"), "(?<=[0-9])[ -](?=[0-9])", "\ue000")
    cols = {
        "_email": found(text.contains("@"), STRICT_EMAIL, marked),
        "_ip": found(text.rlike(r"[0-9]\.[0-9]"), STRICT_IP),
        "_run": found(text.rlike("[0-9](?:[ -]?[0-9]){12}"), DIGIT_RUN, joined),
        "_phone": found(text.contains("+"), STRICT_PHONE),
        "_email2": found(text.rlike(r"(?i)[\[({]at[\])}]| at [A-Za-z0-9-]+ dot "), LOOSE_EMAIL),
        "_ip2": found(number & text.rlike("(?:[0-9A-Fa-f]{1,4}:){7}"), LOOSE_IP),
        "_iban": found(number & text.rlike("[A-Z]{2}[0-9]{2}"), IBAN),
        "_phone2": found(number & text.rlike("[0-9]{3}[ .-][0-9]{4}|0[1-9][0-9]*[)]?[ ./-][0-9]"), LOOSE_PHONE),
    }
    out = df.withColumns(cols)

    def shaped(kind: int, col: str, base: bool, keep=None) -> Column:
        kept = F.filter(F.col(col), keep) if keep else F.col(col)

        def shape(x: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lit(base).alias("base"),
                F.substring(text, x["start"] + 1, x["end"] - x["start"]).alias("text"),
                F.substring(text, F.greatest(x["start"] - LEFT, F.lit(0)) + 1, F.least(x["start"], F.lit(LEFT))).alias("left"),
                F.substring(text, x["end"] + 1, F.lit(RIGHT)).alias("right"),
            )

        return F.transform(kept, shape)

    def count(x: Column) -> Column:
        return F.length(digits(x["text"]))

    base = F.concat(
        shaped(EMAIL, "_email", True),
        shaped(IP, "_ip", True, lambda x: x["text"].rlike(OCTETS)),
        shaped(CARD, "_run", True, lambda x: (count(x) >= 16) & (count(x) <= 19) & luhn(digits(x["text"]))),
        shaped(PHONE, "_phone", True, lambda x: (count(x) >= 8) & (count(x) <= 15)),
    )
    more = F.concat(
        shaped(EMAIL, "_email2", False),
        shaped(IP, "_ip2", False),
        shaped(CARD, "_run", False, lambda x: (count(x) >= 13) & (count(x) <= 15)),
        shaped(CARD, "_iban", False, lambda x: account_check(x["text"])),
        shaped(PHONE, "_phone2", False),
    )
    out = out.withColumn("_base", base).withColumn("_more", more).drop(*cols)
    apart = F.filter("_more", lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return out.withColumn("candidates", F.array_sort(F.concat("_base", apart))).drop("_base", "_more")


def among(value: Column, values) -> Column:
    """Whether a gazetteer holds a value."""
    return F.array_contains(F.array(*map(F.lit, values)), value)


def account_check(text: Column) -> Column:
    """Whether the check digits of an account number are right (remainder 1 by 97)."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4))), "")

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), step) == 1


def votes(c: Column) -> list[Column]:
    """The labelers' votes on a candidate: strict, check, gazetteer, people, context, touched, form."""
    kind, text = c["kind"], c["text"]
    number = digits(text)
    account = (kind == CARD) & text.rlike("^[A-Z]")
    local = ~c["base"] & (kind == PHONE)
    trunk = local & number.startswith("0")
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    worded = (kind == EMAIL) & text.rlike("(?i) (?:at|dot) ")
    blanks = local & ~text.rlike("[^0-9 ]")
    strict = F.when(c["base"], yes).otherwise(none)
    form = F.when(c["base"] | (kind == CARD), none).when(worded | blanks, no).otherwise(yes)
    check = (
        F.when(worded, none)
        .when(kind == EMAIL, F.when(text.rlike(r"^[^@\[({ ]{1,64}[@\[({ ]"), yes).otherwise(no))
        .when(kind == IP, F.when(text.rlike(r"^0[0-9]+\.|\.0[0-9]"), no).otherwise(yes))
        .when(account, F.when(account_check(text), yes).otherwise(no))
        .when(kind == CARD, F.when(luhn(number), yes).otherwise(no))
        .when(trunk, F.when(F.length(number).between(8, 12), yes).otherwise(no))
        .when(local, F.when(number.rlike("^[2-9][0-8][0-9][2-9]"), yes).otherwise(no))
        .otherwise(F.when(F.length(number).between(9, 13), yes).otherwise(none))
    )
    ending = F.lower(F.regexp_extract(text, r"([A-Za-z]+)$", 1))
    plans = F.array(*[F.struct(F.lit(code).alias("code"), F.lit(low).alias("low"), F.lit(high).alias("high")) for code, low, high in PLANS])
    planned = F.exists(plans, lambda p: number.startswith(p["code"]) & (F.length(number) - F.length(p["code"])).between(p["low"], p["high"]))
    issuers = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("low", "high", "least", "most"), row, strict=True)]) for row in ISSUERS])
    first = F.left(number, F.lit(6)).try_cast("int")
    issued = F.exists(issuers, lambda r: first.between(r["low"], r["high"]) & F.length(number).between(r["least"], r["most"]))
    lengths = F.array(*[F.lit(f"{country}{n}") for country, n in ACCOUNTS.items()])
    held = F.array_contains(lengths, F.concat(F.left(text, F.lit(2)), F.length(F.replace(text, F.lit(" "), F.lit(""))).cast("string")))
    gazetteer = (
        F.when(kind == EMAIL, F.when(among(ending, DOMAINS), yes).otherwise(no))
        .when(kind == IP, F.when(text.rlike(NO_ONES_NETWORK), no).when(text.rlike("^[23][0-9A-Fa-f]{3}:"), yes).otherwise(none))
        .when(account, F.when(held, yes).otherwise(no))
        .when(kind == CARD, F.when(issued, yes).otherwise(no))
        .when(local, none)
        .otherwise(F.when(planned, yes).otherwise(no))
    )
    before = F.lower(F.regexp_extract(c["left"], r"([A-Za-z-]+)[^A-Za-z]*$", 1))
    owner = F.lower(F.regexp_extract(text, r"^([A-Za-z-]+)", 1))
    people = (
        F.when((kind == EMAIL) & among(owner, POSTS), no)
        .when((kind == EMAIL) & among(owner, NAMES), yes)
        .when(among(before, NAMES), yes)
        .otherwise(none)
    )
    around = F.concat(c["left"], F.lit(" "), c["right"])
    near = F.coalesce(*[F.when((kind == k) & around.rlike(p), True) for k, p in enumerate(NEAR)], F.lit(False))
    context = F.when(c["left"].rlike(AGAINST), no).when(near, yes).otherwise(none)
    touched = F.when(c["left"].rlike("[A-Za-z0-9_]$") | c["right"].rlike("^[A-Za-z0-9_]"), no).otherwise(none)
    return [strict, check, gazetteer, people, context, touched, form]


def surface(c: Column) -> Column:
    """Features of a candidate for the span classifier, each with its kind; their number is bounded."""
    text = c["text"]
    shape = F.regexp_replace(F.regexp_replace(F.substring(text, 1, 64), "[0-9]+", "9"), "[A-Za-z]+", "a")
    plain = lambda x: F.regexp_replace(F.regexp_replace(x, "[^ -~]", "u"), "[A-Za-z0-9]", "a")
    word = F.lower(F.regexp_extract(c["left"], r"([A-Za-z]+)[^A-Za-z]*$", 1))
    named = {
        "shape": F.pmod(F.xxhash64(shape), F.lit(256)),
        "digits": F.least(F.length(digits(text)), F.lit(20)),
        "length": F.least(F.floor(F.length(text) / 4), F.lit(16)),
        "before": plain(F.right(c["left"], F.lit(1))),
        "after": plain(F.left(c["right"], F.lit(1))),
        "word": F.pmod(F.xxhash64(word), F.lit(1024)),
    }
    return F.array(*[F.concat(F.lit(name + ":"), c["kind"].cast("string"), F.lit(":"), of.cast("string")) for name, of in named.items()])


class Reliabilities(NamedTuple):
    """Chances that a kind is personal (strict candidates, then looser ones), and of a vote for personal and other spans.

    A labeler's row is (no, no opinion, yes).  How often it has no opinion is
    held to be alike for both, so that place is 0 and counts for nothing.
    """

    prior: list[float]
    personal: list[list[float]]
    other: list[list[float]]

    def log_odds(self, group: Column, cast: list[Column]) -> Column:
        def pick(of: Column, values: dict) -> Column:
            return F.coalesce(*[F.when(of == k, F.lit(v)) for k, v in values.items()], F.lit(0.0))

        total = pick(group, {k: math.log(p / (1 - p)) for k, p in enumerate(self.prior)})
        for vote, yes, no in zip(cast, self.personal, self.other, strict=True):
            total = total + pick(vote, {v - 1: math.log(yes[v] / no[v]) for v in (0, 2)})
        return total


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def group_of(c: Column) -> Column:
    """A candidate's place among the priors."""
    return c["kind"] + F.when(c["base"], 0).otherwise(len(KINDS))


def updated(sums: dict[str, float]) -> Reliabilities:
    """Estimates from weighed counts; the chances to start from count as STRENGTH more candidates."""

    def prior(k: int) -> float:
        start = STRICT_PRIOR if k < len(KINDS) else LOOSE_PRIOR
        yes, no = sums.get(f"g{k}yes", 0.0), sums.get(f"g{k}no", 0.0)
        return (yes + STRENGTH * start) / (yes + no + STRENGTH)

    def share(i: int, side: str, start: float) -> list[float]:
        no, yes = sums.get(f"v{i}_0{side}", 0.0), sums.get(f"v{i}_2{side}", 0.0)
        rate = (yes + STRENGTH * start) / (yes + no + STRENGTH)
        return [1 - rate, 0.0, rate]

    return Reliabilities(
        [prior(k) for k in range(2 * len(KINDS))],
        [share(i, "yes", YES_PERSONAL[i]) for i in range(LABELERS)],
        [share(i, "no", YES_OTHER[i]) for i in range(LABELERS)],
    )


def vote_columns() -> list[Column]:
    return [F.col(f"v{i}") for i in range(LABELERS)]


def reliabilities(found: DataFrame) -> Reliabilities:
    """Expectation-maximisation over the counts of vote patterns of all candidates ``c``.

    The pattern table has at most 8 * 3^7 rows; the driver holds the estimates.
    """
    cast = [v.alias(f"v{i}") for i, v in enumerate(votes(F.col("c")))]
    groups = found.select(group_of(F.col("c")).alias("g"), *cast).groupBy("g", *vote_columns())
    patterns = groups.agg(F.count(F.lit(1)).alias("n")).coalesce(1).checkpoint()
    now = updated({})
    for _ in range(ITERATIONS):
        p = logistic(now.log_odds(F.col("g"), vote_columns()))
        weighed = patterns.select("*", (F.col("n") * p).alias("yes"), (F.col("n") * (1 - p)).alias("no"))
        sums = [F.sum(F.when(F.col("g") == k, F.col(s))).alias(f"g{k}{s}") for k in range(2 * len(KINDS)) for s in ("yes", "no")]
        sums += [F.sum(F.when(F.col(f"v{i}") == v - 1, F.col(s))).alias(f"v{i}_{v}{s}") for i in range(LABELERS) for v in (0, 2) for s in ("yes", "no")]
        now = updated({k: v or 0.0 for k, v in weighed.agg(*sums).first().asDict().items()})
    return now


def classifier(found: DataFrame, labelers: Reliabilities) -> DataFrame:
    """(feature, weight): naive Bayes log-odds of surface features from the looser candidates' probabilities.

    Counts are smoothed by STRENGTH candidates, so few examples say little.
    Strict candidates are no examples: they are settled, look unlike the looser
    ones and outnumber them.
    """
    c = F.col("c")
    p = logistic(labelers.log_odds(group_of(c), vote_columns()))
    loose = found.where(~c["base"]).select("c", *[v.alias(f"v{i}") for i, v in enumerate(votes(c))])
    seen = loose.select(F.explode(F.concat(F.array(F.concat(F.lit("all:"), c["kind"].cast("string"))), surface(c))).alias("feature"), p.alias("p"))
    sums = seen.groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).withColumn("kind", F.split("feature", ":")[1])
    whole = sums.where(F.col("feature").startswith("all:")).select("kind", F.col("yes").alias("all_yes"), F.col("no").alias("all_no"))
    yes = (F.col("yes") + STRENGTH / 2) / (F.col("all_yes") + STRENGTH)
    no = (F.col("no") + STRENGTH / 2) / (F.col("all_no") + STRENGTH)
    return sums.where(~F.col("feature").startswith("all:")).join(whole, "kind").select("feature", F.log(yes / no).alias("weight"))


def decided(df: DataFrame) -> DataFrame:
    """``df`` with candidates; adds ``spans``, those of them that are personal data.

    The classifier's table has a bounded number of features and reaches the
    rows as a one-value subquery.  A candidate's score is the sum of the log-odds
    of its votes, its kind's prior among them, and of its surface features.
    """
    ensure_checkpoint_dir(df.sparkSession)
    found = df.select(F.explode("candidates").alias("c"))
    labelers = reliabilities(found)
    weights = classifier(found, labelers)
    table = weights.agg(F.map_from_entries(F.collect_list(F.struct("feature", "weight"))).alias("m"))
    scored = df.withColumn("_weights", table.scalar())

    def personal(c: Column) -> Column:
        weight = lambda acc, f: acc + F.coalesce(F.col("_weights")[f], F.lit(0.0))
        total = F.aggregate(surface(c), labelers.log_odds(group_of(c), votes(c)), weight)
        return c["base"] | (total >= 0)

    return scored.withColumn("spans", F.filter("candidates", personal)).drop("_weights")


def listed(spans: Column) -> Column:
    """``kind:start:end`` by kind, then start, comma-joined; empty for none."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (strict spans), base_sha256, spans of every row.

    Offsets are code points, ends exclusive.  A null or empty text has no
    spans; repeated rows and null ids stay.  Candidates of all rows are worked
    out once and checkpointed without the texts.
    """
    ensure_checkpoint_dir(df.sparkSession)
    docs = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    rows = decided(candidates(docs).drop("text").checkpoint())
    base = F.filter("candidates", lambda c: c["base"])
    kinds = F.transform(base, lambda c: c["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span of its text replaced by ``<kind>``; overlapping spans by the first one's kind.

    All other columns come back as they are, whatever their names.  The texts
    are searched once: rows are checkpointed with their candidates.
    """
    ensure_checkpoint_dir(df.sparkSession)
    others = [c for c in df.columns if c != text_col]
    kept = F.struct(F.lit(0).alias("n"), *[df[c].alias(f"c{i}") for i, c in enumerate(others)])
    rows = decided(candidates(df.select(kept.alias("kept"), df[text_col].alias("text"))).checkpoint())
    text, name = F.col("text"), F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("<"), name[s["kind"]], F.lit(">"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(gap, mark)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    built = F.aggregate(ordered, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    changed = F.when(F.size("spans") > 0, built).otherwise(text)
    return rows.select(*[changed.alias(c) if c == text_col else F.col(f"kept.c{others.index(c)}").alias(c) for c in df.columns])
