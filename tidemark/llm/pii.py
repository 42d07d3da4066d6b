"""Personal data by weak supervision, in DataFrame functions only.

Base kinds (email, ip, card, phone) are found by their patterns and checks, and always reported. Further
candidates (local phone numbers and card numbers that run into other digits, account numbers, social security
numbers, names after a title) are reported only if a classifier accepts them. Every candidate gets the votes (yes, no, abstain) of four labelers:

- strict: a narrower form of its kind, for account numbers their check digits;
- gazetteer: lists of top-level domains, reserved networks, issuers, country and area codes, lengths of account numbers by
  country, ranges of social security numbers in use, given names, and words after a title that are no names;
- context: words in the 24 characters before it that announce, or speak against, personal data;
- neighbours: what touches it on either side.

Counts of vote patterns over all documents are all that the fit needs, and there are at most some 46,000
different ones, whatever the corpus. Expectation-maximisation on them estimates how reliable each labeler is and
how likely each pattern is personal data; a logistic classifier over kind, votes and what no labeler knows (length, variety
of characters, how many other candidates the text has) is then trained on those posteriors, and its weights become a
column expression.

Null text counts as empty and has no spans. Rows are judged one by one with the shared weights: repeated rows get
equal results. Patterns go over each text once: the rows are kept with their candidates in the shared folder, and the
weights are applied to what was kept. Extra columns, whatever their names, are left alone by redact() and dropped by find().
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, whole_row
from tidemark.llm.spans import MARK, plain, with_spans

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("local_phone", "local_card", "account", "ssn", "name")
KINDS = BASE_KINDS + MORE_KINDS
VOTES = ("strict", "gazetteer", "context", "neighbours")

# Gazetteers and context words.
DOMAINS = "com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ch|at|nl|be|pl|br|mx|ar|ca|au|in|jp|cn"
RESERVED_DOMAINS = "example|test|invalid|localhost|local"
RESERVED_NETWORKS = r"0|127|255|192\.0\.2|198\.51\.100|203\.0\.113"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|35|30[0-5]|36|38"
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Mme|Mlle|Sr|Sra|Don|Doña"
COUNTRY_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
AREA_CODES = "201|202|203|205|206|207|208|209|210|212|213|214|215|216|217|224|225|228|229|231|234|239|240|248|251|252|253|254|256|260|262|267|269|270|276|281|301|302|303|304|305|307|308|309|310|312|313|314|315|316|317|318|319|321|323|334|336|337|339|347|351|352|360|361|386|401|402|404|405|406|407|408|409|410|412|413|414|415|417|419|423|425|432|434|435|440|443|469|478|479|480|484|501|502|503|504|505|507|508|509|510|512|513|515|516|517|518|520|530|540|541|551|559|561|562|563|570|571|573|574|580|585|586|601|602|603|605|606|607|608|609|610"
FREE_CODES = "800|833|844|855|866|877|888|900"
ACCOUNT_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24}
USED_AREAS = r"00[1-9]|0[1-9][0-9]|[1-5][0-9]{2}|6[0-57-9][0-9]|66[0-57-9]|7[0-2][0-9]|73[0-3]|7[56][0-9]|77[0-2]"
KNOWN_FAKES = "078-05-1120|219-09-9999|457-55-5462|123-45-6789|987-65-4320"
GIVEN_NAMES = "Anna|Ana|Anne|Antonio|Barbara|Carlos|Carmen|Charles|Christian|Claire|Daniel|David|Elena|Elizabeth|Emma|Eva|Francisco|Hans|Hannah|Isabel|James|Jan|Jean|Jennifer|Johann|John|Jorge|Jose|José|Juan|Julia|Karl|Klaus|Laura|Linda|Louis|Lucas|Luis|Manuel|Marc|Maria|María|Marie|Mark|Martin|Mary|Michael|Michel|Miguel|Nicolas|Pablo|Patricia|Paul|Pedro|Peter|Philippe|Pierre|Richard|Robert|Sarah|Sofia|Sophie|Stefan|Susan|Thomas|Ursula|William|Wolfgang"
NOT_NAMES = "President|Speaker|Chairman|Minister|Secretary|Ambassador|Director|Mayor|Doctor|Professor|Präsident|Minister|Direktor|Président|Ministre|Directeur|Presidente|Ministro|Director|Who|No|Right|Wrong"
FOR = "mail|contact|phone|tel|call|fax|mobile|card|visa|account|iban|ssn|social|name|address|addr|write to|reach|correo|kontakt|adresse|nom|nombre"
AGAINST = "version|ver\\.|v\\.|isbn|issn|order|invoice|build|release|section|chapter|page|total|sum|sha|md5|hash|commit"

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "A-Za-z0-9-"
#: Patterns use runs of one character class, which the regex engine walks without recursion however long they are.
_EMAIL = f"(?:(?<![{MARK}{_LOCAL}])|\\G)[{MARK}{_LOCAL}]++@(?=[{_LABEL}]++{MARK})[{MARK}{_LABEL}]++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])[0-9][0-9\x20-]++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_LOCAL_PHONE = r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
_LOCAL_CARD = r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"
_ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_NAME = rf"(?<![\p{{L}}0-9])(?:{TITLES})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?"

CANDIDATES = "array<struct<kind:string,start:int,stop:int,base:boolean,strict:int,gazetteer:int,context:int,neighbours:int,traits:int>>"
#: Characters of the shortest match of any kind; spans in a block.
_LEAST, _BLOCK = 5, 64


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits, 16 to 19 of them, pass the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(19)),
        F.lit(0),
        lambda acc, k: acc + F.when(k > F.length(digits), 0).otherwise(_luhn_term(F.substring(digits, -k, F.lit(1)).cast("int"), k)),
    )
    return total % 10 == 0


def _luhn_term(digit: Column, place: Column) -> Column:
    doubled = digit * 2
    return F.when(place % 2 == 1, digit).when(doubled > 9, doubled - 9).otherwise(doubled)


_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.regexp_like(m, F.lit(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}")),
    "card": lambda m: F.when(F.length(_digits(m)).between(16, 19), _luhn(_digits(m))).otherwise(F.lit(False)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
    "local_card": lambda m: _luhn(_digits(m)),
}
_STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{16,19}|(?:[0-9]{4}[ -]){3}[0-9]{4})$",
    "phone": r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}$",
    "local_phone": r"^(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}-)[2-9][0-9]{2}-[0-9]{4}$",
    "local_card": r"^(?:[0-9]{16}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4})$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "name": r"^\p{Lu}[\p{L}]*\.? \p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$",
}


def _checked(match: Column) -> Column:
    """Whether the check digits of an account number are right: its remainder by 97, the first four characters last, is 1."""
    packed = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(packed, F.lit(5), F.length(packed)), F.left(packed, F.lit(4))), "")
    worth = lambda sign: F.when(sign.between("0", "9"), sign.try_cast("int")).otherwise(F.ascii(sign) - 55)
    step = lambda rest, n: (rest * F.when(n > 9, 100).otherwise(10) + n) % 97
    return F.aggregate(F.transform(F.filter(turned, lambda sign: sign != ""), worth), F.lit(0), step) == 1


def _vote(yes: str | None, no: str | None) -> Callable[[Column], Column]:
    """1 where the match is of the yes pattern, else -1 where it is of the no pattern, else 0."""

    def vote(match: Column) -> Column:
        out = F.when(F.regexp_like(match, F.lit(yes)), 1) if yes else F.when(F.lit(False), 1)
        return (out.when(F.regexp_like(match, F.lit(no)), -1) if no else out).otherwise(0)

    return vote


def _account_vote(match: Column) -> Column:
    lengths = F.create_map(*(F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in pair))
    wanted = F.element_at(lengths, F.left(match, F.lit(2)))
    return F.when(F.length(F.replace(match, F.lit(" "), F.lit(""))) == wanted, 1).when(wanted.isNotNull(), -1).otherwise(0)


_ISSUER = _vote(rf"^(?:{ISSUERS})", ".")
_KNOWN: dict[str, Callable[[Column], Column]] = {
    "email": _vote(rf"\.(?:{DOMAINS})$", rf"[@.](?:{RESERVED_DOMAINS})$"),
    "ip": _vote(None, rf"^(?:{RESERVED_NETWORKS})\."),
    "card": _ISSUER,
    "phone": _vote(rf"^\+(?:{COUNTRY_CODES})", "."),
    "local_phone": _vote(rf"^\(?(?:{AREA_CODES})", rf"^\(?(?:{FREE_CODES}|[01])"),
    "local_card": _ISSUER,
    "account": _account_vote,
    "ssn": lambda match: F.when(match.isin(*KNOWN_FAKES.split("|")), -1).otherwise(_vote(rf"^(?:{USED_AREAS})-", ".")(match)),
    "name": _vote(rf"^\p{{L}}+\.? (?:{GIVEN_NAMES})(?:$| )", rf"^\p{{L}}+\.? (?:{NOT_NAMES})(?:$| )"),
}


def _candidate(kind: str, span: Column, base: Column) -> Column:
    match, before = span["match"], F.lower(span["before"])
    yes_no = lambda test: F.when(test, 1).otherwise(-1)
    touching = F.regexp_like(span["before"], F.lit(r"[\p{L}0-9_/=#.]\z")) | F.regexp_like(span["after"], F.lit(r"^[\p{L}0-9_/=#]"))
    context = F.when(F.regexp_like(before, F.lit(rf"(?:{AGAINST})[^.!?\n]*\z")), -1).when(F.regexp_like(before, F.lit(rf"(?:{FOR})[^.!?\n]*\z")), 1).otherwise(0)
    size = F.least(F.floor(F.length(match) / 8), F.lit(3))
    variety = F.least(F.floor(F.size(F.array_distinct(F.split(F.regexp_replace(match, r"[^\p{L}0-9]", ""), ""))) / 4), F.lit(3))
    return F.struct(
        F.lit(kind).alias("kind"),
        span["start"].alias("start"),
        span["stop"].alias("stop"),
        base.alias("base"),
        yes_no(_checked(match) if kind == "account" else F.regexp_like(match, F.lit(_STRICT[kind]))).alias("strict"),
        _KNOWN[kind](match).alias("gazetteer"),
        context.alias("context"),
        yes_no(~touching).alias("neighbours"),
        (size + 4 * variety).cast("int").alias("traits"),
    )


def _candidates(kind: str, base: bool):
    return lambda span: _candidate(kind, span, F.lit(base))


def _valid(kind: str):
    return lambda span: _VALID[kind](span["match"])


def with_candidates(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with an array of candidates with votes, by kind and start. Column names that begin with __tm_ are in use here.

    traits: length in eights (0 to 3), plus 4 times the different letters and digits in fours (0 to 3), plus 16 times the
    other candidates of the text (none, one, two or three, more).
    """
    marked = F.regexp_replace("__tm_t", rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", MARK)
    chained = F.regexp_replace("__tm_t", r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", "\x03")
    df = df.withColumn("__tm_t", plain(F.col(text)))
    df = df.withColumn("__tm_digit", F.regexp_like("__tm_t", F.lit("[0-9]")))
    df = df.withColumns({"__tm_mail_t": F.when(F.contains("__tm_t", F.lit("@")), marked).otherwise(F.lit("")), "__tm_num": F.when(F.col("__tm_digit"), F.col("__tm_t")).otherwise(F.lit(""))})
    df = df.withColumn("__tm_chain", F.when(F.col("__tm_digit"), chained).otherwise(F.lit("")))
    number, chain, mail = F.col("__tm_num"), F.col("__tm_chain"), F.col("__tm_mail_t")
    patterns = {
        "email": (mail, _EMAIL),
        "ip": (number, _IP),
        "card": (chain, _CARD),
        "phone": (number, _PHONE),
        "local_phone": (number, _LOCAL_PHONE),
        "local_card": (number, _LOCAL_CARD),
        "account": (number, _ACCOUNT),
        "ssn": (number, _SSN),
        "name": (F.col("__tm_t"), _NAME),
    }
    names = {kind: f"__tm_{kind}_found" for kind in KINDS}
    df = with_spans(df, {names[kind]: patterns[kind] for kind in KINDS}, _LEAST)
    df = df.withColumn(names["email"], F.transform(names["email"], lambda s: s.withField("match", F.translate(s["match"], MARK, ".")).withField("before", F.translate(s["before"], MARK, "."))))
    df = df.withColumns({names[kind]: F.filter(names[kind], _valid(kind)) for kind in _VALID})
    df = df.withColumn("__tm_base", F.concat(*(F.transform(names[kind], _candidates(kind, True)) for kind in BASE_KINDS)))
    free = lambda s: ~F.exists("__tm_base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    more = [F.transform(F.filter(names[kind], free), _candidates(kind, False)) for kind in MORE_KINDS]
    df = df.withColumn("__tm_all", F.concat("__tm_base", *more))
    others = F.size("__tm_all") - 1
    company = F.when(others < 2, others).when(others < 4, 2).otherwise(3)
    df = df.withColumn(out, F.transform("__tm_all", lambda c: c.withField("traits", c["traits"] + 16 * company)).cast(CANDIDATES))
    return df.drop("__tm_all", "__tm_t", "__tm_digit", "__tm_mail_t", "__tm_num", "__tm_chain", "__tm_base", *names.values())


def vote_counts(candidates: DataFrame, column: str) -> list[tuple[str, tuple[int, ...], int, int]]:
    """(kind, votes, traits, count) for each pattern; at most 9 kinds * 3**4 votes * 64 traits."""
    one = candidates.select(F.explode(column).alias("c"))
    rows = one.groupBy(*(F.col(f"c.{name}").alias(name) for name in ("kind", *VOTES, "traits"))).agg(F.count("*").alias("n")).collect()
    return sorted((row.kind, tuple(row[name] for name in VOTES), row["traits"], row.n) for row in rows)


def reliabilities(counts: list[tuple[str, tuple[int, ...], int, int]], rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """By expectation-maximisation: P(vote | truth) as [labeler, truth, vote + 1], and P(personal) for each pattern."""
    votes = np.array([v for _, v, _, _ in counts]) + 1
    weight = np.array([n for *_, n in counts], float)
    kinds = np.array([KINDS.index(kind) for kind, *_ in counts])
    posterior = 1 / (1 + np.exp(-(votes - 1).sum(axis=1).astype(float)))
    # Labelers are taken to be better than chance: prior counts say so, and also smooth patterns never seen.
    prior = np.array([[6.0, 3.0, 1.0], [1.0, 3.0, 6.0]])
    chance = np.empty((len(VOTES), 2, 3))
    for _ in range(rounds):
        share = np.array([[(weight * (kinds == k) * (p if y else 1 - p)).sum() + 1 for y, p in ((0, posterior), (1, posterior))] for k in range(len(KINDS))])
        for labeler in range(len(VOTES)):
            for truth, p in ((0, 1 - posterior), (1, posterior)):
                seen = np.bincount(votes[:, labeler], weights=weight * p, minlength=3) + prior[truth]
                chance[labeler, truth] = seen / seen.sum()
        score = np.log(share[kinds]) + sum(np.log(chance[labeler][:, votes[:, labeler]]).T for labeler in range(len(VOTES)))
        fresh = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -60, 60)))
        if np.abs(fresh - posterior).max() < 1e-9:
            break
        posterior = fresh
    return chance, posterior


def _features(kind: str, votes: tuple[int, ...], traits: int) -> list[float]:
    return [1.0, *(float(kind == k) for k in KINDS), *(float(vote == v) for vote in votes for v in (-1, 1)), *((traits >> shift & 3) / 3 for shift in (0, 2, 4))]


def classifier(counts: list[tuple[str, tuple[int, ...], int, int]], ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic classifier over _features(), trained on the posteriors of reliabilities() by Newton steps."""
    _, posterior = reliabilities(counts)
    x = np.array([_features(kind, votes, traits) for kind, votes, traits, _ in counts])
    # Counts enter by their logarithm, so one frequent pattern doesn't drown the others.
    weight = np.log1p(np.array([n for *_, n in counts], float))
    theta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (posterior - p)) - ridge * theta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(theta))
        theta += (step := np.linalg.solve(bend, slope))
        if np.abs(step).max() < 1e-8:
            break
    return theta


def _score(c: Column, theta: np.ndarray) -> Column:
    """The classifier's linear score of a candidate as a column."""
    w = [float(x) for x in theta]
    total = F.lit(w[0])
    for shift, weight in zip((0, 2, 4), w[-3:]):
        total = total + F.shiftright(c["traits"], shift).bitwiseAND(3) * F.lit(weight / 3)
    for k, kind in enumerate(KINDS):
        total = total + F.when(c["kind"] == kind, F.lit(w[1 + k])).otherwise(0.0)
    for k, name in enumerate(VOTES):
        no, yes = w[1 + len(KINDS) + 2 * k : 3 + len(KINDS) + 2 * k]
        total = total + F.when(c[name] == -1, F.lit(no)).when(c[name] == 1, F.lit(yes)).otherwise(0.0)
    return total


def accepted(column: str, theta: np.ndarray | None, certainty: float = 0.5) -> Column:
    """The base candidates, and those further ones that the classifier holds likelier than certainty."""
    least = math.log(certainty / (1 - certainty))
    return F.filter(column, lambda c: c["base"] if theta is None else c["base"] | (_score(c, theta) > least))


def fit(candidates: DataFrame, column: str) -> np.ndarray | None:
    """The classifier for the candidates of a corpus; None without any."""
    counts = vote_counts(candidates, column)
    return classifier(counts) if counts else None


def find(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, stop, base and votes, by kind and start) for each row of docs."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stored = Scratch(spark).keep(with_candidates(picked, "text", "candidates").select("doc_id", "candidates"))
    return stored.select("doc_id", accepted("candidates", fit(stored, "candidates")).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["stop"].cast("string"))), ",")


def redact(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with each span replaced by its kind in brackets; overlapping spans become one replacement.

    The rows are kept once, as they are and with their candidates; the weights are fitted on these and applied to them,
    so no key is needed, repeated or null ids don't matter, and no pattern goes over a text twice.
    """
    picked = docs.select(whole_row(docs), F.col(text).alias("body"))
    stored = Scratch(spark).keep(with_candidates(picked, "body", "found").select("row", "found"))
    found = F.array_sort(F.transform(accepted("found", fit(stored, "found")), lambda c: F.struct(c["start"], c["stop"], c["kind"])))
    out = stored.select("row", F.col("row")[text].alias("body"), found.alias("spans"))
    # A span that begins before the end of an earlier one goes into the replacement of that one. before: how far the
    # spans before each reach, by blocks, so that a text with many spans costs little more than their number.
    out = out.withColumn("stops", F.transform("spans", lambda c: c["stop"]))
    blocks = F.sequence(F.lit(0), F.floor((F.size("spans") - 1) / _BLOCK).cast("int"))
    out = out.withColumn("tops", F.when(F.size("spans") > 0, F.transform(blocks, lambda b: F.array_max(F.slice("stops", b * _BLOCK + 1, _BLOCK)))))
    out = out.withColumn("tops", F.transform("tops", lambda _, b: F.coalesce(F.array_max(F.slice("tops", F.lit(1), b)), F.lit(0))))
    here = lambda k: F.coalesce(F.array_max(F.slice("stops", F.floor(k / _BLOCK).cast("int") * _BLOCK + 1, k % _BLOCK)), F.lit(0))
    out = out.withColumn("before", F.transform("spans", lambda _, k: F.greatest(F.get("tops", F.floor(k / _BLOCK).cast("int")), here(k))))
    numbered = F.transform("spans", lambda c, k: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), k.alias("k")))
    out = out.withColumn("heads", F.filter(numbered, lambda c: F.get("before", c["k"]) <= c["start"]))
    stop = lambda j: F.when(j + 1 < F.size("heads"), F.get("before", F.get("heads", j + 1)["k"])).otherwise(F.array_max("stops"))
    out = out.withColumn("places", F.transform("heads", lambda c, j: F.struct(c["start"].alias("start"), stop(j).alias("stop"), c["kind"].alias("kind"))))
    body = F.col("body")
    pieces = F.transform(
        "places",
        lambda c, k: F.concat(
            F.substring(body, F.when(k == 0, 1).otherwise(F.get("places", k - 1)["stop"] + 1), c["start"] - F.when(k == 0, 0).otherwise(F.get("places", k - 1)["stop"])),
            F.lit("["),
            F.upper(c["kind"]),
            F.lit("]"),
        ),
    )
    tail = F.substring(body, F.get("places", F.size("places") - 1)["stop"] + 1, F.length(body))
    clean = F.when(F.size("places") > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(body)
    return out.withColumn("clean", clean).select(*((F.col("clean") if c == text else F.col("row")[c]).alias(c) for c in docs.columns))
