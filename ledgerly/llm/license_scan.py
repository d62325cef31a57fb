"""License scan by ordered signature rules (DataFrame functions only).

Every word of a text is held against the keywords of the rules. Around a
keyword a window of words is cut out, and the keyword's rules, and no others,
are tried on it. A detection is an interval of words; of overlapping ones, an
interval that lies within one of a better level, or within a longer one of the
same level, is suppressed. Everything happens inside the row of a text, so
nothing is shuffled and a text's work grows with its words.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.llm import license_rules
from ledgerly.llm.license_rules import Rule

#: What parts the words of a text, once A-Z are lower-cased: all of ASCII but digits and lower-case letters.
NONWORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words before and after a keyword that a rule may reach to.
BEFORE, AFTER = 16, 24
#: Score of a detection by level; base phrases have level 0.
STRENGTH = (0.5, 1.0, 0.9, 0.6, 0.3)
LEVELS = len(STRENGTH)

RULES: list[Rule] = license_rules.parse(license_rules.RULES)
BASE: list[Rule] = license_rules.parse(license_rules.BASE)


def lowered(text: Column) -> Column:
    """The text with A-Z lower-cased, as far as words of ASCII letters go.

    ``lower`` also folds letters outside ASCII, which no rule tells apart; the
    Kelvin sign, the only one that would become an ASCII letter, is first put
    out of its way.
    """
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))


def by_keyword(rules: list[Rule]) -> Column:
    """A constant map from keyword to its rules."""
    table: dict[str, list] = {}
    for r in rules:
        table.setdefault(r.keyword, []).append(
            {"rule": r.rule, "label": r.label, "level": r.level, "pattern": f"(?:^| )({r.pattern})(?: |$)"})
    kind = "map<string,array<struct<rule:int,label:string,level:int,pattern:string>>>"
    return F.from_json(F.lit(json.dumps(table)), kind)


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def sites(words: Column, keywords: list[str]) -> Column:
    """(at, word, window) for each word that is a keyword; the window marks it with ``<``."""
    def window(at: Column) -> Column:
        before = F.slice(words, F.greatest(F.lit(1), at + 1 - BEFORE), F.least(at, F.lit(BEFORE)))
        return F.concat(F.concat_ws(" ", before), F.when(at > 0, F.lit(" <")).otherwise(F.lit("<")),
                        F.concat_ws(" ", F.slice(words, at + 1, F.lit(AFTER + 1))))
    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(keywords), i)), lambda i: i.isNotNull())
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.get(words, i).alias("word"), window(i).alias("window")))


def detections(found: Column, rules: Column) -> Column:
    """(start, back, level, rule, label, stop) of every rule that matches at a site; ``back`` is -stop, so that long ones sort first."""
    def tried(site: Column) -> Column:
        matched = F.transform(F.element_at(rules, site["word"]), lambda r: F.struct(
            r.alias("r"), F.call_function("regexp_extract", site["window"], r["pattern"], F.lit(1)).alias("m")))

        def interval(x: Column) -> Column:
            start = (site["at"] - spaces(F.substring_index(x["m"], "<", 1))).cast("int")
            stop = start + spaces(x["m"]) + 1
            return F.struct(start.alias("start"), (-stop).alias("back"), x["r"]["level"].alias("level"),
                            x["r"]["rule"].alias("rule"), x["r"]["label"].alias("label"), stop.alias("stop"))
        return F.transform(F.filter(matched, lambda x: x["m"] != ""), interval)
    return F.sort_array(F.flatten(F.filter(F.transform(found, tried), lambda d: d.isNotNull())))  # null: not a keyword of these rules


def survivors(found: Column) -> Column:
    """The detections that no other one suppresses.

    In the order of start, longest first, then level and rule, whatever may
    suppress a detection comes before it: so it is suppressed exactly when
    one of its level or better, met earlier, reaches as far.
    """
    kind = "struct<start:int,back:int,level:int,rule:int,label:string,stop:int>"
    none = F.struct(F.array_repeat(F.lit(-1), LEVELS).alias("reach"), F.array().cast(f"array<{kind}>").alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        covered = F.array_max(F.slice(acc["reach"], F.lit(1), d["level"] + 1)) >= d["stop"]
        reach = F.transform(acc["reach"], lambda r, k: F.when(k == d["level"], F.greatest(r, d["stop"])).otherwise(r))
        return F.when(covered, acc).otherwise(F.struct(reach.alias("reach"), F.concat(acc["kept"], F.array(d)).alias("kept")))
    return F.aggregate(found, none, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, rules: list[Rule] = RULES, base: list[Rule] = BASE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, base and detections (arrays of start, stop, level, rule, label).

    ``base`` holds all places of the base phrases, which nothing suppresses;
    ``detections`` what is left of the rules' own ones. Words count from 0,
    ``stop`` is the word after the last. Null and empty texts have no words
    and no detections; null ids stay null; repeated rows are scanned each on
    its own. Other columns are not read, so their names cannot clash. A text
    is scanned whole, and held with its words at several times its size. An
    empty table gives no rows.
    """
    words = F.filter(F.split(lowered(F.col(text_col)), NONWORD), lambda w: w != "")
    keywords = sorted({r.keyword for r in rules + base})

    def scanned(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("long").alias("n_words"), sites(ws, keywords).alias("sites"))
    out = docs.select(F.col(id_col), F.get(F.transform(F.array(words), scanned), 0).alias("scan"))
    out = out.select(id_col, F.col("scan.n_words").alias("n_words"),
                     detections(F.col("scan.sites"), by_keyword(base)).alias("base"),
                     detections(F.col("scan.sites"), by_keyword(rules)).alias("found"))
    plain = lambda d: F.struct(*[d[c].alias(c) for c in ("start", "stop", "level", "rule", "label")])
    return out.select(id_col, "n_words", F.transform("base", plain).alias("base"),
                      F.transform(survivors(F.col("found")), plain).alias("detections"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_words, n_base, first_word, last_word, base_labels, labels and score from the rows of ``scan``.

    The score is the strength of the strongest detection, 0 without any.
    """
    joined = lambda *cols: F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*cols))))
    strength = F.array(*[F.lit(float(s)) for s in STRENGTH])
    best = F.array_max(F.transform(F.concat("base", "detections"), lambda d: F.get(strength, d["level"])))
    return scanned.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"), F.array_max("base.start").cast("long").alias("last_word"),
        joined("base.label").alias("base_labels"), joined("base.label", "detections.label").alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"))
