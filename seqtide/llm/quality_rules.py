"""Quality rules: a table of thresholds compiled into one projection.

``measures`` counts words, letters, symbols, lines and repetitions of a text with
built-in functions; ``verdict`` turns the threshold table into one boolean. Ratios
are compared as integers, so no rounding can move a border.

Null texts count as empty: no words, all counts 0, rejected. Texts of any length
take time in proportion to n log n words and are seen whole. Each row is judged by
itself: repeated rows get equal verdicts, no rows give none; ``judge`` keeps all
columns of its input and adds its own under the names in ``MEASURES`` and
``kept``, replacing columns of the same names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = "[\\x20\\x09-\\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"

#: Common words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from "
    "de la le et les des en un du une que est pour qui dans par sur au pas avec "
    "der die und den von zu das sich mit auf für ist nicht im dem ein eine "
    "el y los las se del por con no su para es al lo").split()


@dataclass(frozen=True)
class Rule:
    """``least`` <= part / whole <= ``most``, as fractions; a missing border does not bind."""

    name: str
    part: str
    whole: str
    least: tuple[int, int] | None = None
    most: tuple[int, int] | None = None


#: The thresholds. Columns are those of ``MEASURES``; ``one`` makes a plain count.
RULES = (
    Rule("enough words", "n_words", "one", least=(50, 1)),
    Rule("few repeated passages", "n_repeat_words", "n_words", most=(1, 2)),
    Rule("usual word length", "word_chars", "n_words", least=(5, 2), most=(12, 1)),
    Rule("few symbols", "n_symbols", "n_words", most=(1, 10)),
    Rule("stop words", "n_stop_words", "one", least=(2, 1)),
    Rule("words with letters", "n_letter_words", "n_words", least=(7, 10)),
    Rule("few repeated lines", "n_dup_lines", "n_lines", most=(2, 5)),
    Rule("few cut lines", "n_cut_lines", "n_lines", most=(3, 10)),
    Rule("few list lines", "n_list_lines", "n_lines", most=(9, 10)),
)
BASE = ("enough words", "few repeated passages")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words",
            "n_letter_words", "n_lines", "n_cut_lines", "n_list_lines")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more."""
    def covered(windows: Column) -> Column:
        # sorted by window, a repeated one stands beside its equal
        by_window = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                             | (F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
            return F.array_sort(F.transform(again, lambda x: x["i"]))

        def width(p: Column) -> Column:
            gaps = F.transform(p, lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get(p, i - 1))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
        return _let(_let(by_window, places), width)

    def counted(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - 3),
                              lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))
        return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                    .otherwise(covered(w)))
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(
        _let(F.transform(words, lambda w: F.xxhash64(w)), counted))


def measures(text: Column) -> Column:
    """Struct of ``MEASURES``, all long."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_SPACES)) != "")
    stops = F.array(*[F.lit(v) for v in sorted({f(w) for w in STOP_WORDS for f in (str.lower, str.capitalize, str.upper)})])

    def of_lines(ls: Column) -> list[Column]:
        cut = F.filter(ls, lambda x: F.btrim(x, F.lit(_SPACES)).endswith("..."))
        listed = F.filter(ls, lambda x: F.substring(F.btrim(x, F.lit(_SPACES)), 1, 1).isin("-", "*", "•"))
        return [(F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"), F.size(ls).alias("n_lines"),
                F.size(cut).alias("n_cut_lines"), F.size(listed).alias("n_list_lines")]

    def of_words(ws: Column) -> list[Column]:
        return [F.size(ws).alias("n_words"), F.char_length(F.array_join(ws, "")).alias("word_chars"),
                F.size(F.array_intersect(ws, stops)).alias("n_stop_words"), repeated_words(ws).alias("n_repeat_words")]

    by_word = _let(words, lambda ws: F.struct(*of_words(ws)))
    by_line = _let(lines, lambda ls: F.struct(*of_lines(ls)))
    return F.struct(by_word.alias("w"), by_line.alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols"),
                    F.regexp_count(text, F.lit("\\p{L}[^\\x20\\x09-\\x0D]*")).alias("n_letter_words"))


def verdict(rules: tuple[Rule, ...]) -> Column:
    """True where every rule holds on the columns of ``MEASURES``."""
    out = F.lit(True)
    for r in rules:
        part, whole = F.col(r.part), F.lit(1) if r.whole == "one" else F.col(r.whole)
        if r.least:
            out &= part * r.least[1] >= whole * r.least[0]
        if r.most:
            out &= part * r.most[1] <= whole * r.most[0]
    return out


def verdict_sql(rules: tuple[Rule, ...]) -> str:
    """The same test as SQL text."""
    parts = []
    for r in rules:
        whole = "1" if r.whole == "one" else r.whole
        if r.least:
            parts.append(f"{r.part} * {r.least[1]} >= {whole} * {r.least[0]}")
        if r.most:
            parts.append(f"{r.part} * {r.most[1]} <= {whole} * {r.most[0]}")
    return " and ".join(parts)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with its measures, ``base_failed`` and ``kept``."""
    base = tuple(r for r in rules if r.name in BASE)
    found = docs.withColumn("_m", measures(F.col("text")))
    place = {n: f"_m.w.{n}" for n in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")}
    place |= {n: f"_m.l.{n}" for n in ("n_dup_lines", "n_lines", "n_cut_lines", "n_list_lines")}
    place |= {n: f"_m.{n}" for n in ("n_symbols", "n_letter_words")}
    out = found.withColumns({n: F.col(place[n]).cast("long") for n in MEASURES}).drop("_m")
    return out.withColumns({"base_failed": ~verdict(base), "kept": verdict(rules)})


def kept(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{n}`").alias(f"_{i}") for i, n in enumerate(names)], F.col("text"))
    passed = judge(plain, rules).where("kept")
    return passed.select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])


ORACLE = f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, word, i from (
        select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from (
          select doc_id, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from t))),
tri as (select doc_id, i, word, lead(word, 1) over d as w2, lead(word, 2) over d as w3 from w
        window d as (partition by doc_id order by i)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, word, w2, w3) as n
                               from tri where w3 is not null) where n > 1),
covered as (select doc_id, count(distinct i + k) as n_repeat_words from rep, (select unnest([0, 1, 2]) as k) group by 1),
by_word as (select doc_id, count(*) as n_words, sum(length(word)) as word_chars,
                   count(distinct case when word in ({", ".join(f"'{v}'" for w in STOP_WORDS for v in sorted({w, w.capitalize(), w.upper()}))}) then word end) as n_stop_words,
                   count(*) filter (regexp_matches(word, '\\p{{L}}')) as n_letter_words from w group by 1),
ln as (select doc_id, line from (select doc_id, unnest(string_split(text, chr(10))) as line from t)
       where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
by_line as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
                   count(*) filter (regexp_matches(line, '\\.\\.\\.[\\x20\\x09-\\x0D]*$')) as n_cut_lines,
                   count(*) filter (regexp_matches(line, '^[\\x20\\x09-\\x0D]*[-*•]')) as n_list_lines from ln group by 1),
m as (select t.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0)::bigint as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
             coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_stop_words, 0) as n_stop_words,
             coalesce(n_letter_words, 0) as n_letter_words, coalesce(n_lines, 0) as n_lines,
             coalesce(n_cut_lines, 0) as n_cut_lines, coalesce(n_list_lines, 0) as n_list_lines
      from t left join by_word using (doc_id) left join by_line using (doc_id) left join covered using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       not ({verdict_sql(tuple(r for r in RULES if r.name in BASE))}) as base_failed,
       ({verdict_sql(RULES)}) as kept
from m
"""
