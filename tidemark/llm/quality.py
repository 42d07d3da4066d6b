"""Quality rules, line first, in DataFrame functions only.

Words are runs of other characters than ASCII white space. Base figures of a text: words, their code points,
symbols, lines equal to an earlier line, and words inside windows of eight words that occur twice or more. A text
fails the base rules with fewer than 20 words, or if more than 30 % of its words lie in repeated windows.

Then each line with a word is judged on its own:

- punctuation: more than a tenth of its word characters are symbols, or less than half of them are letters;
- navigation: a line of at most 12 words that has two or more separators, or begins with a menu phrase;
- boilerplate: phrases of notices make up a tenth or more of its word characters, of which it has 300 at most.

Phrases are those of English, German, French and Spanish pages. One that a long line happens to hold doesn't count
against it, as notices are short and say little else.

Lines that fail are removed. A text that loses more than `most_lost` of its word characters this way is rejected.
Lines go first, so a good text with a notice at its end loses the notice, not its place.

Null text counts as empty: no words, so it fails the base rules and is not kept. Rows are judged one by one:
nothing is shuffled, repeated rows get equal results, other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANKS = " \t\n\x0b\x0c\r"
_BLANK = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Phrases that mark a line.
NAVIGATION = (
    "home|menu|next page|previous page|back to top|skip to|read more|click here|log ?in|sign ?(?:in|up)|share this|site ?map|"
    "startseite|menü|nächste seite|vorherige seite|nach oben|weiterlesen|mehr lesen|hier klicken|anmelden|registrieren|"
    "accueil|page suivante|page précédente|haut de page|lire la suite|en savoir plus|cliquez ici|connexion|s'inscrire|plan du site|"
    "inicio|menú|página siguiente|página anterior|volver arriba|leer más|haga clic aquí|iniciar sesión|mapa del sitio"
)
BOILERPLATE = (
    "all rights reserved|cookie (?:policy|settings|notice)|(?:use|uses|accept) cookies|privacy policy|terms of (?:use|service)|copyright (?:©|[(]c[)]|[0-9]{4})|licensed under|enable javascript|lorem ipsum|powered by|subscribe to|© ?[0-9]{4}|©|"
    "alle rechte vorbehalten|cookie-(?:richtlinie|einstellungen)|verwendet cookies|datenschutzerklärung|nutzungsbedingungen|impressum|javascript aktivieren|newsletter abonnieren|"
    "tous droits réservés|politique de (?:cookies|confidentialité)|utilise des cookies|mentions légales|conditions d'utilisation|activer javascript|abonnez-vous|"
    "todos los derechos reservados|política de (?:cookies|privacidad)|utiliza cookies|aviso legal|términos de uso|condiciones de uso|activar javascript|suscríbete"
)
#: Word characters of the longest line that can be a notice.
NOTICE = 300


def _visible(text: Column) -> Column:
    """Code points that aren't blanks."""
    return F.length(F.regexp_replace(text, f"[{_BLANK}]+", "")).cast("long")


def _symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")


def _line(line: Column) -> Column:
    """A line with what the rules look at more than once: lambdas compute a repeated expression each time.

    others: its characters but letters and blanks, which are few in most lines.
    """
    return F.struct(line.alias("line"), F.regexp_replace(line, rf"[\p{{L}}{_BLANK}]+", "").alias("others"), _visible(line).alias("visible"))


def line_fails(row: Column) -> Column:
    """Whether a line as made by _line() breaks a rule; one without words doesn't."""
    line, others, visible = row["line"], row["others"], row["visible"]
    punctuation = (2 * F.length(others) > visible) | (10 * _symbols(others) > visible)
    # What is dear comes last, for the few lines that are short or look like a menu.
    menu = F.regexp_like(others, F.lit("[|>»›][^|>»›]*[|>»›]")) | ((visible <= NOTICE) & F.regexp_like(F.lower(line), F.lit(rf"^[ \t]*+(?:{NAVIGATION})(?:[^\p{{L}}]|$)")))
    navigation = menu & (F.size(F.split(F.btrim(line, F.lit(_BLANKS)), f"[{_BLANK}]+")) <= 12)
    notice = F.length(line) - F.length(F.regexp_replace(F.lower(line), BOILERPLATE, ""))
    return (visible > 0) & (punctuation | navigation | ((visible <= NOTICE) & (10 * notice >= visible)))


def _covered_words(at: Column) -> Column:
    """Words inside windows that start at the sorted positions."""
    reach = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))).cast("long"))
    return F.aggregate(reach, F.lit(0).cast("long"), lambda total, n: total + n)


def measure(docs: DataFrame, most_lost: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars, kept and the cleaned text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.lit(0).cast("long")
    trimmed = F.btrim("text", F.lit(_BLANKS))
    hashes = F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(trimmed, f"[{_BLANK}]+"), lambda word: F.xxhash64(word)))
    # Two references to an array keep the optimizer from moving its making into a lambda that runs for each item.
    out = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .select("*", hashes.alias("words"), F.split("text", "\n").alias("lines"))
        .select("*", F.filter("lines", lambda line: F.btrim(line, F.lit(_BLANKS)) != "").alias("filled"))
        .select(
            "*",
            F.when(
                F.size("words") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda at: F.xxhash64(F.slice("words", at, WINDOW)))
            ).alias("windows"),
        )
        .select("*", (F.size(F.array_distinct("windows")) < F.size("windows")).alias("repeats"))
        .select("*", F.when(F.col("repeats"), F.array_sort(F.transform("windows", lambda h, k: F.struct(h.alias("h"), k.alias("k"))))).alias("ordered"))
        .select(
            "*",
            F.array_sort(
                F.transform(
                    F.filter("ordered", lambda w, k: F.coalesce(F.get("ordered", k - 1)["h"] == w["h"], F.lit(False)) | F.coalesce(F.get("ordered", k + 1)["h"] == w["h"], F.lit(False))),
                    lambda w: w["k"],
                )
            ).alias("at"),
        )
        .select(
            "doc_id",
            "text",
            "lines",
            "filled",
            F.size("words").cast("long").alias("n_words"),
            _visible(F.col("text")).alias("word_chars"),
            _symbols(F.col("text")).alias("n_symbols"),
            (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long").alias("n_dup_lines"),
            F.when(F.col("repeats"), _covered_words(F.col("at"))).otherwise(none).alias("n_repeat_words"),
        )
        .select("*", ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"))
        .select("*", F.transform("lines", _line).alias("rows"))
        .select("*", F.transform(F.filter("rows", lambda row: ~line_fails(row)), lambda row: row["line"]).alias("good"))
        .select("*", F.when(F.size("good") == F.size("lines"), F.col("text")).otherwise(F.concat_ws("\n", "good")).alias("clean_text"))
        .select("*", F.when(F.size("good") == F.size("lines"), none).otherwise(F.col("word_chars") - _visible(F.col("clean_text"))).alias("lost_chars"))
    )
    kept = ~F.col("base_failed") & (F.col("lost_chars") <= most_lost * F.col("word_chars"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_chars", kept.alias("kept"), "clean_text")


def oracle_sql(most_lost: float = 0.5) -> str:
    """DuckDB SQL for the digest that the registered query returns."""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    visible = lambda column: f"length(regexp_replace({column}, '[\\x20\\x09-\\x0D]+', '', 'g'))"
    quoted = lambda pattern: pattern.replace("'", "''")
    symbols = lambda column: f"length(regexp_replace({column}, '[^#*$%&|<>]+', '', 'g'))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id::bigint AS doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM d),
win AS (SELECT r, k, array_to_string(words[k:k + 7], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS k FROM w WHERE len(words) >= 8)),
rep AS (SELECT r, k FROM win QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
cov AS (SELECT r, sum(least(8, coalesce(lead_k - k, 8)))::bigint AS n FROM (SELECT r, k, lead(k) OVER (PARTITION BY r ORDER BY k) AS lead_k FROM rep) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
f AS (SELECT r, line, {visible("line")} AS vis, {symbols("line")} AS sym, length(regexp_replace(line, '[^\\p{{L}}]+', '', 'g')) AS letters,
  len(regexp_split_to_array(trim(line, {blanks}), '[\\x20\\x09-\\x0D]+')) AS words, length(regexp_replace(line, '[^|>»›]+', '', 'g')) AS seps, lower(line) AS low FROM l),
g AS (SELECT r, line, vis, 10 * sym > vis OR 2 * letters < vis OR (words <= 12 AND (seps >= 2 OR vis <= {NOTICE} AND regexp_matches(low, '^[ \\t]*(?:{quoted(NAVIGATION)})(?:[^\\p{{L}}]|$)')))
  OR vis <= {NOTICE} AND 10 * (length(line) - length(regexp_replace(low, '{quoted(BOILERPLATE)}', '', 'g'))) >= vis AS bad FROM f WHERE vis > 0),
a AS (SELECT r, (count(*) - count(DISTINCT line))::bigint AS dup, sum(CASE WHEN bad THEN vis ELSE 0 END)::bigint AS lost FROM g GROUP BY r),
j AS (SELECT d.doc_id, len(w.words)::bigint AS n_words, {visible("d.text")}::bigint AS word_chars, {symbols("d.text")}::bigint AS n_symbols,
  coalesce(a.dup, 0)::bigint AS n_dup_lines, coalesce(cov.n, 0)::bigint AS n_repeat_words, coalesce(a.lost, 0)::bigint AS lost_chars
  FROM d JOIN w USING (r) LEFT JOIN a USING (r) LEFT JOIN cov USING (r)),
b AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lost_chars <= {most_lost} * word_chars AS kept, lost_chars FROM b
"""
