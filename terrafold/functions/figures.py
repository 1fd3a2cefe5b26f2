"""Figures in prose: what a reader reads as a number, what is exempt, and words that stand for a number.

Patterns are Java's with Unicode classes, so that a no-break space is a space and every engine that
knows Unicode finds the same tokens. What a rule exempts is data: a table of rules is folded over a text
once, and gives the text that is left and how often each rule applied. A list marker is not cut out but
marked in place, so that a token that begins at it is known from one that does not.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What is generated, what a figure looks like, and what is none.
GENERATED = r"(?s)\[\[\[cog.*?\[\[\[end\]\]\]"
UNIT = r"(?:km²|km2|m²|MiB|GiB|%|×|ha\b|cm\b|m\b|-?metres?\b|years?\b)"
DATE = r"(?:18|19|20)\d\d-\d\d(?:-\d\d)?"
YEAR = r"^(?:18|19|20)\d\d(?:-\d\d(?:-\d\d)?|\s?[–-]\s?(?:18|19|20)\d\d)?[.,]?$"
STRUCTURE = {
    "doi": r"doi:\S+",
    "url": r"https?://\S+",
    "entity": r"&#\d+;",
    "css": r"rgba?\([^)]*\)|\d+deg\b",
    "interpolation": r"\$\{[^}]*\}",
    "licence": r"CC BY(?:-SA)? \d\.\d",
    "issue": r"#\d+\b",
    "regulation": r"Regulation \(EU\) (?:No )?\d+/\d{4}|Directive \d{4}/\d+/E[CU]",
    "version": r"\bv\d+(?:\.\d+)+\b",
    "comment": r"(?s)<!--.*?-->",
}
REFERENCE = r"(?:[Ss]ection|§|[Ee]poch|EPSG:?|SHA-|analysis[ _]|[Dd]ecisions?\s?(?:M\d\.)?|[Gg]uardrail G)\s?\d+\.?"
SUPERSCRIPT = r"(?s)<sup>.*?</sup>"
TAG = r"<[^>]+>"
# Number words, fractions, idioms that are none, and how near a figure must be.
ONES = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
TEENS = ["ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen"]
TENS = ["twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety"]
SCALES = ["hundred", "thousand", "million", "billion"]
FRACTIONS = r"a (?:third|quarter|fifth|tenth)|two[- ]thirds|three[- ]quarters|(?:one|two|three|four|five|six|seven|eight|nine) in (?:ten|five|four|three)|[a-z]+-fold"
IDIOMS = r"(?i)third part(?:y|ies)|as a third\b|a third surface"
MENTION = r"[\"“][^\"“”\n]{1,80}[\"”]"
REACH = 60

#: A mark before the number of a list item, and what stands for it in a text that has it already.
MARK, OTHER = "\ue000", "\ue001"
#: Digits, perhaps marked; only a token's first number can be told to be marked, the others may be.
NUMBER = rf"{MARK}?\d[\d.,]*"
FIGURE = "|".join((
    rf"{MARK}?{DATE}", rf"{MARK}?\d{{1,3}} (?:to \d{{1,3}} )?times in \d{{1,3}}",
    rf"{NUMBER}\s?±\s?{NUMBER}(?:\s?{UNIT})?", rf"{NUMBER}\s?[–-]\s?{NUMBER}(?:\s?{UNIT})?", rf"{NUMBER}(?:\s?{UNIT})?"))
FIGURE = rf"(?<![A-Za-z0-9_])(?:{FIGURE})"
LIST_MARKER = r"((?:^|\n)\s{0,3}(?:#{1,6}\s+)?)(\d{1,2}\.(?=\s))"
#: A word of tens that units may follow, or one of the others, before "fold".
FOLD = rf"(?:(?:{'|'.join(TENS)})-?(?:{'|'.join(ONES)})?|{'|'.join(TEENS + ONES + SCALES)})fold"
QUANTITY = rf"(?i)\b(?:{FRACTIONS}|{FOLD})\b"
#: A generated region in parts: the code, and the output without the comment marks around both.
REGION = r"(?s)\[\[\[cog((?:(?!\[\[\[end).)*?)\]\]\](?:-->|\*/)?((?:(?!\[\[\[end).)*?)(?:<!--|/\*|//|#)?\s*\[\[\[end\]\]\]"


class Rule(NamedTuple):
    """A pattern that exempts what it matches: its place is taken by put; digits: matches without a digit do not count."""

    name: str
    pattern: str
    put: str = " "
    digits: bool = True


def rules(html: bool = False) -> list[Rule]:
    """What is exempt from being a figure, in the order in which it is taken out; tags count for nothing."""
    shown = [Rule("superscript", SUPERSCRIPT, ""), Rule("tag", TAG, "\n")] if html else []
    return [Rule("generated", GENERATED, "", False), *shown, *(Rule(k, p) for k, p in STRUCTURE.items()), Rule("reference", REFERENCE, " ", False)]


def unicode(pattern: str) -> str:
    return "(?U)" + pattern


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern (or of a group in it)."""
    return F.regexp_extract_all(text, F.lit(unicode(pattern)), group)


def with_digits(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t.rlike(r"\d"))


def scrubbed(text: Column, table: Iterable[Rule]) -> tuple[Column, dict[str, Column]]:
    """What the rules leave of a text, and how often each applied to what those before it had left."""

    def step(state: tuple[Column, dict[str, Column]], rule: Rule) -> tuple[Column, dict[str, Column]]:
        body, counts = state
        hits = found(body, rule.pattern)
        return F.regexp_replace(body, unicode(rule.pattern), rule.put), counts | {rule.name: F.size(with_digits(hits) if rule.digits else hits)}

    return reduce(step, table, (text, {}))


def folded(rows: DataFrame, text: str, table: Iterable[Rule]) -> DataFrame:
    """rows with what the rules leave in the column text, and a column by each rule's name, as of scrubbed.

    Every rule is a step of its own: columns of scrubbed that nest in each other are evaluated from the first
    rule on for each count, so that many counts cost the square of the rules.
    """
    for rule in table:
        body, counts = scrubbed(F.col(text), [rule])
        rows = rows.withColumns(counts | {text: body})
    return rows


def normalised(token: Column) -> Column:
    """One spelling per figure: single spaces, metres as "m", no marks."""
    bare = F.regexp_replace(F.translate(token, MARK, ""), unicode(r"\s+"), " ")
    return F.regexp_replace(F.trim(bare), unicode(r"\s?-?metres?$"), " m")


def _marked(body: Column) -> Column:
    """The text with a mark before the number of every list item."""
    return F.regexp_replace(F.translate(body, MARK, OTHER), unicode(LIST_MARKER), f"$1{MARK}$2")


def _tokens(body: Column, html: bool) -> Column:
    return found(body if html else _marked(body), FIGURE)


def is_year(token: Column) -> Column:
    return normalised(token).rlike(unicode(YEAR))


def prose(text: Column, html: bool = False) -> Column:
    """What a reader reads: no generated regions, tags, identifiers or references."""
    return scrubbed(text, rules(html))[0]


def figures(text: Column, html: bool = False) -> Column:
    """The distinct figures of a text: neither generated, nor years, nor numbers of (Markdown) list items."""
    counted = F.filter(_tokens(prose(text, html), html), lambda t: ~t.startswith(MARK) & ~is_year(t))
    # Every figure has a digit: a text without one is not scanned for the rest.
    return F.when(text.rlike("[0-9]"), F.array_distinct(F.transform(counted, normalised))).when(text.isNotNull(), F.array().cast("array<string>"))


def exemptions(text: Column, html: bool = False) -> list[Column]:
    """Counts per rule, and of the years and list markers in what the rules leave."""
    body, counts = scrubbed(text, rules(html))
    tokens = _tokens(body, html)
    counts |= {"year": F.size(F.filter(tokens, is_year)), "list_marker": F.size(F.filter(tokens, lambda t: t.startswith(MARK)))}
    return [c.alias(name) for name, c in counts.items() if name != "tag"]


def surfaces(rows: DataFrame, text: str, html: bool = False) -> DataFrame:
    """rows with the number of figures and the counts of exemptions in place of the column text; each rule runs over a text once."""
    left = folded(rows, text, rules(html)).withColumn(text, _tokens(F.col(text), html))
    tokens = F.col(text)
    counted = F.array_distinct(F.transform(F.filter(tokens, lambda t: ~t.startswith(MARK) & ~is_year(t)), normalised))
    marks = {"figures": F.size(counted), "year": F.size(F.filter(tokens, is_year)), "list_marker": F.size(F.filter(tokens, lambda t: t.startswith(MARK)))}
    names = [r.name for r in rules(html) if r.name != "tag"]
    return left.withColumns(marks).select(*[c for c in rows.columns if c != text], "figures", *names, "year", "list_marker")


def quoted_strings(code: Column) -> Column:
    """String literals of JavaScript, quotes included, without those in comments or generated regions."""
    hidden = [Rule("generated", GENERATED, ""), Rule("block", r"(?s)/\*.*?\*/", ""), Rule("line", r"(?m)^\s*//.*$", "")]
    literal = "|".join(rf"{q}(?:[^{q}\\]|\\.)*{q}" for q in "'\"`")
    return found(scrubbed(code, hidden)[0], literal)


def generated_pairs(text: Column) -> Column:
    """The code and the output of every generated region, without white space around them; both empty where code or output is not closed."""
    part = lambda region, k: F.regexp_replace(F.regexp_extract(region, unicode(REGION), k), unicode(r"(?s)^\s+|\s+$"), "")
    return F.transform(found(text, GENERATED), lambda region: F.struct(part(region, 1).alias("code"), part(region, 2).alias("output")))


def blanked(text: Column, pattern: str) -> Column:
    """The text with spaces in place of what matches, as many as it has characters."""
    gaps, spaces = F.split(text, unicode(pattern), -1), F.transform(found(text, pattern), lambda m: F.repeat(F.lit(" "), F.length(m)))
    return F.array_join(F.flatten(F.zip_with(gaps, spaces, lambda g, s: F.array(g, F.coalesce(s, F.lit(""))))), "")


def located(rows: DataFrame, keys: list[str], text: str, pattern: str) -> DataFrame:
    """rows with start (from 0) and token of each match in the column text; keys name a row."""
    parts = F.arrays_zip(F.split(F.col(text), unicode(pattern), -1).alias("gap"), found(F.col(text), pattern).alias("token"))
    each = rows.select("*", F.posexplode(parts).alias("k", "part")).where("part.token is not null")
    before = Window.partitionBy(*keys).orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    gap, token = F.length("part.gap"), F.length("part.token")
    return each.withColumns({"start": F.coalesce(F.sum(gap + token).over(before), F.lit(0)) + gap, "token": F.col("part.token")}).drop("k", "part")


def bare_quantities(docs: DataFrame, key: str = "doc_id", html: bool = False) -> DataFrame:
    """key, paragraph, start, word: quantity words without a figure (years are none) within REACH characters of their paragraph.

    Generated output is read like other text, for its figures stand beside words as any other's; the code
    that wrote it is not read. Quotations and idioms do not count.
    """
    seen = F.regexp_replace(F.regexp_replace(F.col("text"), unicode(REGION), "$2"), unicode(GENERATED), "")
    seen = blanked(F.regexp_replace(seen, TAG, " ") if html else seen, MENTION)
    parts = docs.select(key, F.posexplode(F.split(seen, "\n\n")).alias("paragraph", "body")).where(F.col("body").rlike(unicode(QUANTITY)))
    at = [key, "paragraph"]
    words = located(parts, at, "body", QUANTITY)
    idioms = located(parts, at, "body", IDIOMS).select(*at, F.col("start").alias("lo"), (F.col("start") + F.length("token")).alias("hi"))
    meets = [words[c] == idioms[c] for c in at] + [idioms["lo"] < words["start"] + F.length(words["token"]), words["start"] < idioms["hi"]]
    used = words.join(idioms, meets, "left_anti")
    first = F.greatest(F.col("start") - REACH, F.lit(0))
    near = F.substring("body", first + 1, F.col("start") - first + F.length("token") + REACH)
    bare = ~F.exists(found(near, FIGURE), lambda t: ~is_year(t))
    return used.where(bare).select(*at, "start", F.lower("token").alias("word"))


# Phrases that promise something, and headings that say that it is done.
TELLS = {
    "undecided": r"\bmust decide\b|\bto be decided\b|\bopen question\b|\bTBD\b|\bTODO\b",
    "provisional": r"\bprovisional\b|\bproposal\b|\bprototype .{0,20}\bat M\d",
    "not done yet": r"\bnot yet\b|\bstill to do\b|\bpending\b|\bis next\b|\bnext milestone\b|\bremains? (?:open|unresolved|to be|undone)\b",
    "blocked": r"\bblocked\b|\bdeferred\b|\bwaits? on\b|\bwaiting on\b",
    "future tense": r"\bwill (?:be|need|decide|register|have to|replace|add)\b|\bM\d[a-z]? (?:must|will)\b",
}
SETTLED = r"\b(?:COMPLETE|DONE|CLOSED|IMPLEMENTED|SETTLED)\b|✅"
LINE_END = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x85\u2028\u2029]"
LEVELS = 4


def forward_phrases(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, line (from 1), section, settled, tells: lines that promise something; code between fences does not count.

    The section is the last heading; it is settled if it, or a heading above it, says that it is done. A
    heading of a level stands above a line unless one of the same or an upper level has come since.
    """
    rows = docs.select(key, F.posexplode(F.split("text", LINE_END)).alias("k", "body"))
    order = Window.partitionBy(key).orderBy("k")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fence = F.col("body").rlike(unicode(r"^\s*```"))
    rows = rows.withColumn("fences", F.count_if(fence).over(so_far)).where(~fence & (F.col("fences") % 2 == 0))
    marks = F.length(F.regexp_extract("body", r"^(#{1,4})\s+(.*)$", 1))
    rows = rows.withColumns({"level": marks, "done": F.col("body").rlike(unicode(SETTLED)), "title": F.regexp_extract("body", r"^#{1,4}\s+(.*)$", 1)})
    last = lambda cond, value: F.last(F.when(cond, value), True).over(so_far)
    for level in range(1, LEVELS + 1):
        rows = rows.withColumn(f"h{level}", last(F.col("level") == level, F.struct("k", "done")))
    above = F.lit(-1)
    settled = F.lit(False)
    for level in range(1, LEVELS + 1):
        at = F.coalesce(F.col(f"h{level}.k"), F.lit(-1))
        settled = settled | ((at > above) & F.coalesce(F.col(f"h{level}.done"), F.lit(False)))
        above = F.greatest(above, at)
    title = last(F.col("level") > 0, F.substring(F.regexp_replace("title", r"[*`]", ""), 1, 58))
    tells = F.array_compact(F.array(*[F.when(F.col("body").rlike(unicode("(?i)" + p)), name) for name, p in TELLS.items()]))
    seen = rows.select(key, (F.col("k") + 1).alias("line"), F.coalesce(title, F.lit("(preamble)")).alias("section"), settled.alias("settled"), tells.alias("tells"))
    return seen.where(F.size("tells") > 0)
