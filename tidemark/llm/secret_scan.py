"""Secret scan: wide candidate patterns, and a random forest that removes false positives, in DataFrame functions only.

Candidates are values after a key word and a sign of assignment, passwords in addresses (`scheme://user:password@`),
signed web tokens, private key blocks, and tokens of 12 or more letters, digits and `+/_-` that hold a digit. Values are
found first, so a token that ends in a key word hides none; a token inside a value is part of it. A text without a digit,
a sign of assignment or a key block holds none, and isn't looked at further.

Features of a candidate: its length, how often neighbouring characters change class, the share of different characters,
digits, upper case and runs of vowels in it, how much of it whole words of a list cover, whether it has an issuer's form
or that of a placeholder, whether it stands in a path, in an address or after a sign of assignment, and whether the 24
characters before it (runs of blanks as one) speak of secrets or of identifiers, hashes and versions.

The forest is trained from labelled findings, a table (value, before, after, label) of any origin. Without one,
labelled_findings() gives a built-in table: its rows follow from their number by fixed rules, from many forms of secrets
and of look-alikes, so that no form decides alone.

Null text counts as empty and has no findings. The control characters 1, 2, 4 and 5 in a text count as character 3. Rows are judged one by one; equal rows give equal findings. Other
columns of the input don't matter. The forest's size is bounded by its parameters, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch
from tidemark.llm.spans import MARK, MARK_2, plain, with_spans

# Words that announce a secret, words that speak against one, forms that issuers give their tokens, forms of
# placeholders, and the word list for coverage.
_KEY = r"""(?:password|passwd|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key)[A-Za-z0-9_.-]*+["']?[ \t]*+(?::=|=>|[=:])[ \t]*+["']?"""
_FOR = "password|passwd|pwd|secret|token|api.?key|access.?key|private.?key|credential|auth|bearer"
_AGAINST = "commit|sha|md5|hash|checksum|uuid|guid|version|revision|build|order|invoice|isbn|doi|serial|digest|phone|card|etag|request"
_ISSUED = r"^(?:AKIA|ASIA|gh[pousr]_|github_pat_|sk-|[sr]k_(?:live|test)_|xox[abprs]-|glpat-|AIza|npm_|hf_|SG\.|eyJ[A-Za-z0-9_-]+\.|-----BEGIN )"
_PLACEHOLDER = r"^(?:[$%<{\[(]|process\.env|os\.environ|(?:null|none|nil|true|false|undefined|todo|changeme|redacted|example)$)|^(.)\1+$|\($|\(\)|\.get"
WORDS = (
    "about access account action active address admin after again all api application array auth base based before best between bool build byte call cache change channel check class click client code "
    "command commit common company config connection content control count create current data database date debug default delete demo design detail dev device different digest document domain "
    "download email enable encoder end entry error event example export false field file filter find first folder form format from function get group handle handler hash have header host html "
    "http image import index info information input instance item java job json key language last layout level library license line link list load local log login main make manager map master "
    "member message method model module name network new next node none null number object old open option order output page parameter parser part password path place point private process product "
    "profile project property public query read record region release remote report request required reset resource response result return role route run sample save schema script search secret section "
    "see select server service session set settings shown site size source start state status step storage store string style submit system table tag target task temp test text the this time title "
    "token type undefined update upload url user utf value version view web will with word work world write your"
).split()[:200]

_CLASS = r"A-Za-z0-9_+/-"
_TOKEN = rf"(?<![{_CLASS}])[A-Za-z_+/-]*+[0-9][{_CLASS}]*+(?<=[{_CLASS}]{{12}})={{0,2}}"
_VALUE = r"""[^\s"',;]{6,}"""
_ADDRESS = r"(://[^\s/:@]{1,64}:)([^\s/@]{4,})(?=@)"
_WEB_TOKEN = rf"(?<![{_CLASS}])eyJ[A-Za-z0-9_-]{{8,}}\.[A-Za-z0-9_-]{{8,}}\.[A-Za-z0-9_-]{{8,}}"
_KEY_BLOCK = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}+-----END [A-Z ]{0,20}PRIVATE KEY-----"
#: Values and passwords have a mark in front, which ends a token to its left.
_PATTERN = rf"{MARK}{_VALUE}|{MARK_2}[^\s/@]{{4,}}|{_WEB_TOKEN}|{_KEY_BLOCK}|{_TOKEN}"
_LEAST = 4
FEATURES = ["size", "changes", "distinct", "digits", "upper", "vowels", "covered", "issued", "placeholder", "path", "address", "cue", "against", "assigned"]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0).cast("double")


def _flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("double")


def with_features(df: DataFrame, words: Sequence[str] = WORDS) -> DataFrame:
    """df (value, before, after) with the columns in FEATURES. words: the list for coverage, in lower case."""
    value, before, after = F.col("value"), F.lower("before"), F.col("after")
    size = F.length(value)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9]", "-"), "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    letters = F.regexp_replace(F.lower(value), "[^a-z]", "")
    vowel_runs = F.length(F.regexp_replace(F.regexp_replace(letters, "[aeiouy]+", "-"), "[a-z]+", ""))
    parts = F.split(F.lower(F.regexp_replace(value, "([a-z])([A-Z])", "$1 $2")), "[^a-z]+")
    known = F.aggregate(F.filter(parts, lambda part: part.isin(*words)), F.lit(0), lambda total, part: total + F.length(part))
    return df.withColumns(
        {
            "size": F.least(size, F.lit(200)).cast("double"),
            "changes": _share(runs - 1, size),
            "distinct": _share(F.size(F.array_distinct(F.split(value, ""))), F.least(size, F.lit(32))),
            "digits": _share(F.length(F.regexp_replace(value, "[^0-9]", "")), size),
            "upper": _share(F.length(F.regexp_replace(value, "[^A-Z]", "")), size),
            "vowels": _share(vowel_runs, F.length(letters)),
            "covered": _share(known, size),
            "issued": _flag(F.regexp_like(value, F.lit(_ISSUED))),
            "placeholder": _flag(F.regexp_like(F.lower(value), F.lit(_PLACEHOLDER))),
            "path": _flag(F.regexp_like(before, F.lit(r"(?:/|www\.|https?:|\\)[^\s:]*\z")) | (F.length(F.regexp_replace(value, "[^/]", "")) >= 2) | F.regexp_like(after, F.lit(r"^[/\\]"))),
            "address": _flag(F.regexp_like(before, F.lit(r"[^\s/:@]:\z")) & (after == "@")),
            "cue": _flag(F.regexp_like(before, F.lit(rf"(?:{_FOR})[^.!?\n]*\z"))),
            "against": _flag(F.regexp_like(before, F.lit(rf"(?:{_AGAINST})[^.!?\n]*\z"))),
            "assigned": _flag(F.regexp_like(before, F.lit(r"""[=:>][ \t]{0,2}["']?\z"""))),
        }
    )


def _picked(items: Sequence[str], salt: str) -> Column:
    """One of the items, none of which holds the sign between them, by a row's number."""
    chosen = (F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(len(items))) + 1).cast("int")
    return F.element_at(F.split(F.lit("¦".join(items)), "¦"), chosen)


def _finding_parts() -> list[dict[str, Column]]:
    """What findings are made of, from a row's number: columns, and then columns made from those."""
    n = F.col("id").cast("string")
    sign = ["=", ": ", " = ", '="', ": '", ":", " := ", " => "]
    syllables = "ba co di fu ge ha jo ki lu me na po ri su te vo wa xi zu hunt sword dog star rain".split()
    first = {
        "hexes": F.concat(*(F.sha2(F.concat(n, F.lit(x)), 256) for x in "ab")),
        "mixed": F.regexp_replace(F.concat(*(F.base64(F.unhex(F.sha2(F.concat(F.lit(x), n), 256))) for x in "cd")), "=", ""),
        "key": F.concat(
            _picked(["", "and then ", "db_", "MY_", "x-", "export ", "set the "], "lead"),
            _picked(["password", "passwd", "pwd", "secret", "token", "api_key", "access-key", "SECRET_KEY", "auth_token", "Credential"], "key"),
            _picked(sign, "sign"),
        ),
        "bare": _picked(["", "the rest is ", "see ", "of ", "key ", "use "], "bare"),
        "after": _picked([" ", '"', "", ".", ",", "\n"], "after"),
        "one": _picked(WORDS, "w1"),
        "two": _picked(WORDS, "w2"),
        "three": _picked(WORDS, "w3"),
        "made_up": F.concat(F.initcap(_picked(syllables, "1")), _picked(syllables, "2"), _picked(syllables, "3")),
        "salt": F.pmod(F.xxhash64("id", F.lit("size")), F.lit(1 << 20)),
    }
    second = {"plain": F.regexp_replace("mixed", "[+/]", ""), "digits": F.regexp_replace("hexes", "[^0-9]", "")}
    third = {
        "made_up": F.concat("made_up", F.substring("digits", 1, 3), _picked(["", "!", "x", "#a"], "4")),
        "address": F.concat(_picked(["postgres", "https", "amqp", "redis"], "s"), F.lit("://"), "one", F.lit(":")),
        "day": F.concat(F.lit("20"), F.substring("digits", 1, 2), F.lit("-"), F.substring("digits", 3, 2), F.lit("-"), F.substring("digits", 5, 2)),
        "numbers": _picked(["order ", "phone ", "card: ", "isbn ", "invoice=", "", "serial "], "number"),
    }
    return [first, second, third]


def finding_forms() -> dict[str, tuple[Column, Column, Column, int]]:
    """For each form of findings its value, what stands before and after it, and whether it is a secret, from _finding_parts()."""
    n, hexes, mixed, plain62, digits, key, bare, after, word, second, third, made_up, address, day, numbers = (
        F.col(c) for c in ("id", "hexes", "mixed", "plain", "digits", "key", "bare", "after", "one", "two", "three", "made_up", "address", "day", "numbers")
    )
    cut = lambda text, low, wide: F.substring(text, F.lit(1), (F.col("salt") % wide + low).cast("int"))
    marked = F.translate(plain62, "QZqzJ", "!@#$&")
    against = _picked(["commit ", "sha1 ", "revision ", "md5 ", "checksum: ", "hash=", "digest: ", "etag: ", "build ", ""], "against")
    other = _picked(["uuid ", "id=", "request ", "session id: ", "", "guid: "], "other")
    no = F.lit("")
    return {
        "hex after a key": (cut(hexes, 8, 57), key, after, 1),
        "upper hex after a key": (F.upper(cut(hexes, 12, 53)), key, after, 1),
        "lower letters and digits after a key": (F.lower(cut(plain62, 10, 31)), key, after, 1),
        "mixed after a key": (cut(plain62, 8, 57), key, after, 1),
        "base64 after a key": (cut(mixed, 16, 49), key, after, 1),
        "marked after a key": (cut(marked, 8, 25), key, after, 1),
        "made up after a key": (made_up, key, after, 1),
        "issued, in the open": (F.concat(_picked(["AKIA", "ASIA"], "i"), F.upper(F.substring(plain62, 1, 16))), bare, after, 1),
        "issued with a prefix": (F.concat(_picked(["ghp_", "gho_", "sk_live_", "glpat-", "npm_", "hf_", "xoxb-", "AIza"], "i"), cut(plain62, 20, 21)), bare, after, 1),
        "mixed after a word": (cut(plain62, 24, 41), _picked(["bearer ", "auth ", "Authorization: Bearer ", "token "], "word"), after, 1),
        "made up in an address": (made_up, address, F.lit("@"), 1),
        "mixed in an address": (cut(plain62, 8, 25), address, F.lit("@"), 1),
        "web token": (F.concat(F.lit("eyJ"), F.substring(plain62, 1, 20), F.lit("."), F.substring(plain62, 21, 30), F.lit("."), F.substring(plain62, 51, 30)), bare, after, 1),
        "key block": (F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), mixed, F.lit("\n-----END RSA PRIVATE KEY-----")), bare, after, 1),
        "hash": (F.substring(hexes, F.lit(1), _picked(["32", "40", "64"], "h").cast("int")), against, after, 0),
        "identifier": (F.concat_ws("-", *(F.substring(hexes, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), other, after, 0),
        "words and a number": (F.concat(word, F.lit("_"), second, F.lit("_"), F.substring(digits, 1, 3)), bare, after, 0),
        "camel case": (F.concat(word, F.initcap(second), F.substring(digits, 1, 2), F.initcap(third)), bare, after, 0),
        "path": (F.concat(word, F.lit("/"), second, F.lit("/"), F.substring(hexes, 1, 8)), _picked(["/home/", "https://www.site/", "", "src/"], "p"), _picked(["/", " ", ".", ""], "e"), 0),
        "number": (F.substring(digits, F.lit(1), (F.lit(12) + n % 7).cast("int")), numbers, after, 0),
        "version": (F.concat(F.lit("v"), F.substring(digits, 1, 1), F.lit("-"), F.substring(digits, 2, 2), F.lit("-"), word, F.substring(digits, 4, 3)), _picked(["version ", "release ", "", "tag: "], "v"), after, 0),
        "time": (F.concat(day, F.lit("T"), F.substring(digits, 5, 2), F.lit("-"), F.substring(digits, 7, 2)), _picked(["on ", "date=", "", "at: "], "t"), after, 0),
        "dated name": (F.concat(word, _picked(["-", "_", "/"], "j"), day), bare, after, 0),
        "numbers with signs": (F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 4), F.substring(digits, 8, 4), F.substring(digits, 12, 2)), numbers, after, 0),
        "short words with numbers": (F.concat(F.upper(F.substring(word, 1, 3)), F.lit("-"), F.substring(digits, 1, 4), F.lit("-"), F.upper(F.substring(second, 1, 3)), F.substring(digits, 5, 3)), bare, after, 0),
        "plain word after a key": (F.when(F.length(word) >= 6, word).otherwise(F.concat(word, second)), key, after, 0),
        "words after a key": (F.concat(word, _picked(["_", "-", "."], "j"), second, F.lit("_"), third), key, after, 0),
        "placeholder after a key": (_picked(["${DB_PASSWORD}", "<your-token>", "********", "xxxxxxxxxx", "%(password)s", "{{ secret }}", "process.env.TOKEN", "undefined", "config.get(", "changeme", "[REDACTED]"], "x"), key, after, 0),
        "word in an address": (F.concat(word, second), F.concat(F.lit("//"), third, F.lit(":")), no, 0),
    }


def labelled_findings(spark: SparkSession, rows: int = 3600, forms: Sequence[str] | None = None) -> DataFrame:
    """value, before, after, label and form: made from row numbers, the forms (all, or those named) in turn."""
    known = finding_forms()
    names = list(forms or known)
    made = spark.range(0, rows, 1, 1)
    for parts in _finding_parts():
        made = made.withColumns(parts)
    turn = F.col("id") % len(names)
    value, before, after = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for k, name in enumerate(names):
        v, b, a, _ = known[name]
        value, before, after = value.when(turn == k, v), before.when(turn == k, b), after.when(turn == k, a)
    labels = F.array(*(F.lit(float(known[name][3])) for name in names))
    at = (turn + 1).cast("int")
    return made.select(value.alias("value"), before.alias("before"), after.alias("after"), F.element_at(labels, at).alias("label"), F.element_at(F.array(*(F.lit(x) for x in names)), at).alias("form"))


def train(findings: DataFrame, trees: int = 20, depth: int = 7, words: Sequence[str] = WORDS) -> RandomForestClassificationModel:
    """A forest over FEATURES from a table (value, before, after, label)."""
    scratch = Scratch(findings.sparkSession)
    kept = scratch.keep(with_features(findings.select("value", "before", "after", "label"), words).select(*FEATURES, "label"))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(kept).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11).fit(rows)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start, stop, value, before and after of every candidate in the whole texts."""
    text = F.col("text")
    signed = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    addressed = F.when(F.contains(text, F.lit("://")), F.regexp_replace(text, _ADDRESS, f"$1{MARK_2}$2")).otherwise(text)
    marked = F.when(signed, F.regexp_replace(addressed, f"((?i:{_KEY}))({_VALUE})", f"$1{MARK}$2")).otherwise(text)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain(F.col("text")).alias("text"))
    looked_at = signed | F.regexp_like(text, F.lit("[0-9]")) | F.contains(text, F.lit("-----BEGIN "))
    picked = picked.where(looked_at).select("doc_id", marked.alias("text"))
    spans = with_spans(picked, {"spans": (F.col("text"), _PATTERN)}, _LEAST, MARK + MARK_2)
    # Of a plain explode Spark makes a filter on the size of spans, and computes all of it anew there, for each match.
    spans = spans.select("doc_id", F.explode_outer("spans").alias("s")).where(F.col("s").isNotNull())
    return spans.select("doc_id", "s.start", "s.stop", F.translate("s.match", MARK + MARK_2, "").alias("value"), "s.before", "s.after")


def scan(spark: SparkSession, docs: DataFrame, model: RandomForestClassificationModel | None = None, words: Sequence[str] = WORDS) -> DataFrame:
    """doc_id, start, stop, value, score and is_secret of every candidate; a secret scores a half or more."""
    model = model or train(labelled_findings(spark), words=words)
    found = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(candidates(docs), words))
    score = vector_to_array("probability")[1]
    return model.transform(found).select("doc_id", "start", "stop", "value", F.round(score, 6).alias("score"), (score >= 0.5).alias("is_secret"))
