"""Line-first cleaning, then document verdicts, in native expressions only.

Each line is judged by itself: bad lines are removed, and a document that loses
too much of its text is rejected. Line rules:

* navigation: many separators, or nearly every word next to one;
* boilerplate: phrases of page furniture in a short line, in four languages;
* punctuation: mostly symbols, shouted (most words end in "!!"), or a long run
  of words without any sentence punctuation;
* repetition: a line of many words with few distinct ones.

Repeated three-word windows are found by sorting (window hash, position) within
the text and comparing neighbours: O(n log n) for a text of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, n_words, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_FRACTION = 0.5
# Fixed patterns of page furniture in four languages, for lower-cased lines of few words. Phrases match
# between spaces and punctuation, so "dialog in" holds no "log in"; words that are common in prose
# count as a whole line only. Each phrase starts with a plain letter.
BOILERPLATE_PHRASES = (
    "all rights reserved", "licensed under (the|an?) .{0,80}licen[cs]e", "released under (the|an?) .{0,80}licen[cs]e",
    "privacy policy", "cookie policy", "terms of (use|service) (apply|and)", "we use cookies", "this (web)?site uses cookies",
    "accept (all )?cookies", "click here (to|for)", "subscribe to (our|the) newsletter", "enable javascript",
    "lorem ipsum dolor", "skip to (main )?content", "share this (page|post|article) on", "copyright ?(©|\\(c\\)|[0-9]{4})",
    "alle rechte vorbehalten", "datenschutzerklärung lesen", "diese (web)?seite verwendet cookies",
    "unsere (web)?seite verwendet cookies", "newsletter (abonnieren|anmelden)", "cookies akzeptieren",
    "tous droits réservés", "politique de confidentialité", "conditions générales d.utilisation",
    "ce site utilise des cookies", "accepter les cookies", "abonnez-vous à (notre|la) (newsletter|lettre)",
    "todos los derechos reservados", "política de (privacidad|cookies)", "este sitio (web )?(usa|utiliza) cookies",
    "aceptar (las )?cookies", "suscríbete a (nuestro|la) (boletín|newsletter)",
)
BOILERPLATE_LINES = (
    "(read|learn|show) more", "(sign|log) (in|up|out)", "terms of (use|service)", "privacy", "contact( us)?", "impressum",
    "datenschutz(erklärung)?", "nutzungsbedingungen", "weiterlesen", "mehr (lesen|anzeigen)", "anmelden", "mentions légales",
    "lire la suite", "(se connecter|connexion)", "s.inscrire", "aviso legal", "leer más", "iniciar sesión", "registrarse",
)
LINE_WORDS = 6  # most words of a line that is one of BOILERPLATE_LINES, marks around it included
_EDGE = "[\\x00-/:-@\\[-`{-\\x7f«»„“”‘’…–—·•›]"  # what may stand beside a phrase


def by_first_letter(phrases: tuple[str, ...]) -> str:
    """One pattern of all phrases that looks at each first letter once."""
    rest: dict[str, list[str]] = {}
    for x in phrases:
        rest.setdefault(x[0], []).append(x[1:])
    return "|".join(f"{a}(?:{'|'.join(x)})" for a, x in rest.items())


# For lines with a space before and after.
BOILERPLATE = f"{_EDGE}(?:{by_first_letter(BOILERPLATE_PHRASES)}){_EDGE}"
BOILERPLATE_LINE = f"^{_EDGE}*(?:{'|'.join(BOILERPLATE_LINES)}){_EDGE}*$"
BOILERPLATE_WORDS = 20


def _count(lines: str, reason: str) -> Column:
    return F.size(F.filter(lines, lambda x: x["reason"] == reason)).cast("long")


def line_reason(line: Column, n: Column | None = None) -> Column:
    """Why a line (of ``n`` words) is removed: navigation, boilerplate, punctuation, repetition; null if
    it stays."""
    n = n_words(line) if n is None else n
    marks = F.regexp_count(line, F.lit("[|»›•·→]"))
    shouts = F.regexp_count(line, F.lit("!!(?=\\s|$)"))
    symbols = F.regexp_count(line, F.lit("[^\\p{L}\\p{M}\\p{N}\\s]"))
    chars = F.char_length(F.translate(line, SPACE_CHARS, ""))
    return (F.when((marks >= 3) & (marks * 5 >= n), F.lit("navigation"))
            .when((n <= BOILERPLATE_WORDS) & F.contains(line, F.lit("©")), F.lit("boilerplate"))
            .when((n <= LINE_WORDS) & F.lower(line).rlike(BOILERPLATE_LINE), F.lit("boilerplate"))
            .when((n <= BOILERPLATE_WORDS) & F.concat(F.lit(" "), F.lower(line), F.lit(" ")).rlike(BOILERPLATE), F.lit("boilerplate"))
            .when((symbols * 4 > chars) | ((shouts >= 3) & (shouts * 2 > n)), F.lit("punctuation"))
            .when((n >= 20) & ~line.rlike("[.!?:;…]"), F.lit("punctuation"))
            .when((n >= 20) & (F.size(F.array_distinct(words(line))) * 4 < n), F.lit("repetition")))


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
            max_repeat_percent: int = MAX_REPEAT_PERCENT, max_lost: float = MAX_LOST_FRACTION) -> DataFrame:
    """One row a row: key, ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words``, ``base_failed``, the line rules' counts (``n_lines``,
    ``n_removed_lines``, one per rule), ``lost_fraction``, ``clean_text``, ``kept``.

    Null or blank text has no words, fails the base rules and is not kept.
    Repeated rows are judged each by itself; an empty table gives no rows. A text's lines
    and windows are arrays of its row, so a very long text takes memory in proportion.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(key).alias("doc_id"), t.alias("t"))
    d = d.select("doc_id", "t", words(F.col("t")).alias("w"),
                 F.filter(F.transform(F.split("t", "\n"), lambda x: F.struct(x.alias("line"), n_words(x).alias("n"))),
                          lambda x: x["n"] > 0).alias("counted"))
    d = d.withColumn("lines", F.col("counted.line"))
    d = d.select("doc_id", "t", "w", "lines", "counted", F.size("w").cast("long").alias("n_words"),
                 F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
                 F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    windows = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.struct(
        F.xxhash64(F.get("w", i - 1), F.get("w", i), F.get("w", i + 1)).alias("h"), i.alias("i")))
    d = d.withColumn("s", F.when(F.size("w") >= 4, F.sort_array(windows)))
    same = F.filter("s", lambda x, k: F.coalesce((F.get("s", k - 1)["h"] == x["h"]), F.lit(False))
                    | F.coalesce((F.get("s", k + 1)["h"] == x["h"]), F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    d = d.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long")).drop("s", "w")
    judged = F.transform("counted", lambda x: F.struct(x["line"].alias("line"), line_reason(x["line"], x["n"]).alias("reason")))
    d = d.withColumn("j", judged)
    d = d.withColumn("good", F.transform(F.filter("j", lambda x: x["reason"].isNull()), lambda x: x["line"]))
    counts = [_count("j", r).alias(f"n_{r}_lines") for r in ("navigation", "boilerplate", "punctuation", "repetition")]
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    whole, left = F.char_length(F.array_join("lines", "\n")), F.char_length(F.array_join("good", "\n"))
    d = d.select("*", *counts, base.alias("base_failed"), F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size("good")).cast("long").alias("n_removed_lines"),
                 F.when(whole > 0, 1 - left / whole).otherwise(0.0).alias("lost_fraction"),
                 F.array_join("good", "\n").alias("clean_text"))
    d = d.withColumn("kept", ~F.col("base_failed") & (F.col("lost_fraction") <= max_lost))
    return d.select(F.col("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "n_lines", "n_removed_lines", "n_navigation_lines", "n_boilerplate_lines",
                    "n_punctuation_lines", "n_repetition_lines", "lost_fraction", "clean_text")
