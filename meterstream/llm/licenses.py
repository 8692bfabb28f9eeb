"""License scans by ordered signature rules.

A text is folded to words; rules are regular expressions over the words from
some place on.  A text is looked at only if it holds one of a few keywords, a
place only if its word begins a rule, and a rule is tried only where its own
keyword follows.  Detections that lie within another of the same or a better
priority are suppressed; what is left gives the labels and the score.  Base
phrases are always counted and always give their label.

All of it is DataFrame operations on one row at a time, so nothing is shuffled.
"""

from __future__ import annotations

import json
from collections import defaultdict
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_ascii, quoted

#: What separates words, in a text whose A-Z are still to be lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words that a rule may span.
SPAN = 18

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, names as they are written, versions (words), and what may follow a version.
LATER = "(?: only| or(?: at your option)?(?: any)? later(?: version)?)?"
FAMILIES = (
    ("gpl", ("gnu general public license", "general public license", "gnu gpl", "gpl"), ("1", "2", "3"), LATER),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "lesser general public license",
              "gnu lgpl", "lgpl"), ("2", "2 1", "3"), LATER),
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("1", "3"), LATER),
    ("gfdl", ("gnu free documentation license", "free documentation license", "gfdl"), ("1 1", "1 2", "1 3"), LATER),
    ("apache", ("apache license", "apache software license", "apache public license"), ("1 0", "1 1", "2 0"), ""),
    ("mit", ("mit license", "mit licence", "expat license", "mit expat license"), (), ""),
    ("x11", ("x11 license", "mit x11 license"), (), ""),
    ("mit-0", ("mit no attribution license", "mit no attribution"), (), ""),
    ("bsd", ("bsd license", "bsd licence", "bsd style license", "berkeley software distribution license"), (), ""),
    ("bsd-2-clause", ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license", "bsd 2 clause"), (), ""),
    ("bsd-3-clause", ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause"), (), ""),
    ("bsd-4-clause", ("bsd 4 clause license", "4 clause bsd license", "original bsd license"), (), ""),
    ("0bsd", ("zero clause bsd license", "bsd zero clause license", "0bsd"), (), ""),
    ("isc", ("isc license", "isc licence", "internet systems consortium license"), (), ""),
    ("mpl", ("mozilla public license", "mpl"), ("1 0", "1 1", "2 0"), ""),
    ("epl", ("eclipse public license",), ("1 0", "2 0"), ""),
    ("edl", ("eclipse distribution license",), ("1 0",), ""),
    ("cddl", ("common development and distribution license", "cddl"), ("1 0", "1 1"), ""),
    ("cpl", ("common public license",), ("1 0",), ""),
    ("ipl", ("ibm public license",), ("1 0",), ""),
    ("eupl", ("european union public licence", "european union public license", "eupl"), ("1 0", "1 1", "1 2"), ""),
    ("osl", ("open software license",), ("1 0", "2 0", "2 1", "3 0"), ""),
    ("afl", ("academic free license",), ("1 1", "1 2", "2 0", "2 1", "3 0"), ""),
    ("artistic", ("artistic license", "perl artistic license"), ("1 0", "2 0"), ""),
    ("bsl", ("boost software license",), ("1 0",), ""),
    ("busl", ("business source license",), ("1 0", "1 1"), ""),
    ("sspl", ("server side public license",), ("1",), ""),
    ("elastic", ("elastic license",), ("1 0", "2 0"), ""),
    ("ms-pl", ("microsoft public license",), (), ""),
    ("ms-rl", ("microsoft reciprocal license",), (), ""),
    ("apsl", ("apple public source license",), ("1 0", "1 1", "1 2", "2 0"), ""),
    ("nasa", ("nasa open source agreement",), ("1 3",), ""),
    ("ncsa", ("university of illinois ncsa open source license", "ncsa open source license"), (), ""),
    ("psf", ("python software foundation license", "psf license"), ("2",), ""),
    ("php", ("php license",), ("3 0", "3 01"), ""),
    ("ruby", ("ruby license",), (), ""),
    ("postgresql", ("postgresql license", "postgresql licence"), (), ""),
    ("openssl", ("openssl license",), (), ""),
    ("zlib", ("zlib license", "zlib libpng license"), (), ""),
    ("libpng", ("libpng license",), ("2",), ""),
    ("unlicense", ("unlicense", "the unlicense"), (), ""),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), ("2",), ""),
    ("zpl", ("zope public license",), ("1 1", "2 0", "2 1"), ""),
    ("qpl", ("q public license",), ("1 0",), ""),
    ("lppl", ("latex project public license", "lppl"), ("1 0", "1 1", "1 2", "1 3"), ""),
    ("ofl", ("sil open font license", "open font license"), ("1 0", "1 1"), ""),
    ("ubuntu-font", ("ubuntu font licence", "ubuntu font license"), ("1 0",), ""),
    ("cecill", ("cecill license", "cecill"), ("1 0", "1 1", "2 0", "2 1"), ""),
    ("mulan", ("mulan permissive software license", "mulan psl"), ("1", "2"), ""),
    ("odbl", ("open database license", "open data commons open database license", "odbl"), ("1 0",), ""),
    ("odc-by", ("open data commons attribution license",), ("1 0",), ""),
    ("pddl", ("public domain dedication and license", "open data commons public domain dedication and license"), ("1 0",), ""),
    ("cdla", ("community data license agreement",), ("1 0", "2 0"), ""),
    ("cc0", ("cc0", "creative commons zero", "creative commons cc0"), ("1 0",), "(?: universal)?"),
    ("cc-by", ("cc by", "creative commons attribution", "creative commons by"), ("1 0", "2 0", "2 5", "3 0", "4 0"), "(?: international| unported)?"),
    ("cc-by-sa", ("cc by sa", "creative commons attribution share ?alike"), ("1 0", "2 0", "2 5", "3 0", "4 0"), "(?: international| unported)?"),
    ("cc-by-nd", ("cc by nd", "creative commons attribution no ?deriv(?:ative)?s"), ("1 0", "2 0", "2 5", "3 0", "4 0"), "(?: international| unported)?"),
    ("cc-by-nc", ("cc by nc", "creative commons attribution non ?commercial"), ("1 0", "2 0", "2 5", "3 0", "4 0"), "(?: international| unported)?"),
    ("cc-by-nc-sa", ("cc by nc sa", "creative commons attribution non ?commercial share ?alike"), ("1 0", "2 0", "2 5", "3 0", "4 0"), "(?: international| unported)?"),
    ("cc-by-nc-nd", ("cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s"), ("1 0", "2 0", "2 5", "3 0", "4 0"), "(?: international| unported)?"),
)
# Single notices, as label, regular expression over words, keyword, priority, confidence.
NOTICES = (
    ("public-domain", "(?:released|dedicated|placed) (?:in ?to|to) the public domain", "public domain", 1, 0.9),
    ("public-domain", "in the public domain", "public domain", 2, 0.6),
    ("all-rights-reserved", "all rights reserved", "rights reserved", 2, 0.7),
    ("all-rights-reserved", "copyright(?: c)?(?: \\d{4})+(?: [^ ]+){1,6} all rights reserved", "rights reserved", 1, 0.9),
    ("no-derivatives", "no derivative works", "derivative works", 2, 0.5),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", 0, 1.0),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "copy modify", 0, 0.9),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "source and binary", 0, 1.0),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", "express or implied", 0, 0.9),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software", 0, 0.9),
    ("apache", "www apache org licenses license 2 0", "apache org", 0, 1.0),
    ("gpl", "www gnu org licenses gpl", "gnu org", 0, 0.9),
    ("lgpl", "www gnu org licenses lgpl", "gnu org", 0, 0.9),
    ("cc-by", "creativecommons org licenses by \\d \\d", "creativecommons org", 0, 1.0),
    ("cc-by-sa", "creativecommons org licenses by sa \\d \\d", "creativecommons org", 0, 1.0),
    ("cc-by-nc", "creativecommons org licenses by nc \\d \\d", "creativecommons org", 0, 1.0),
    ("cc0", "creativecommons org publicdomain zero \\d \\d", "creativecommons org", 0, 1.0),
)
VERBS = ("licensed", "released", "distributed", "published", "available", "covered", "provided")
#: Each rule's words hold one of these.
KEYWORDS = ("licen", "public domain", "rights reserved", "derivative works", "gpl", "cc by", "cc0", "creative commons",
            "creativecommons org", "hereby granted", "copy modify", "source and binary", "express or implied", "free software",
            "apache org", "gnu org", "gfdl", " mpl ", "cddl", "eupl", "bsd 2", "bsd 3", "mit no", "0bsd", "wtfpl", "lppl", "cecill",
            "mulan psl", "odbl", "open source agreement", "data license")


def _first_words(pattern: str) -> list[str]:
    """The plain words with which a rule can begin."""
    if pattern.startswith("(?:"):
        return pattern[3:pattern.index(")")].split("|")
    return [pattern.split(" ")[0].split("(")[0]]


@lru_cache(maxsize=1)
def rules() -> list[dict]:
    """All rules: label, base, priority (0: best), confidence, keyword, first word, regular expression.

    The expression runs from the start of " word word ... " and its first group
    spans the words of the detection.
    """
    out = []

    def add(label, pattern, keyword, priority, confidence, base=False):
        for first in _first_words(pattern):
            out.append({"label": label, "base": base, "priority": priority, "confidence": confidence, "keyword": keyword,
                        "first": first, "pattern": f"^( {pattern}) "})

    def plain(name):  # the longest part of a name that is the same in all its spellings
        return max(name.replace(" ?", "\0").replace("(?:", "\0").split("\0"), key=len).split(")")[-1].strip() or name

    for phrase, label in BASE.items():
        add(label, phrase, phrase, 3, 0.5, base=True)
    for label, names, versions, after in FAMILIES:
        every = "(?:" + "|".join(sorted(names, key=len, reverse=True)) + ")"
        for v in versions:
            major, _, minor = v.partition(" ")
            numbered = f"{label}-{major}.{minor or '0'}"
            tail = "(?: licen[cs]e)?(?: version| ver| v)? v?" + major + (f" {minor}" if minor not in ("", "0") else "(?: 0)?") + after
            for name in names:
                add(numbered, name + tail, plain(name), 1, 0.9)
            spdx = label.replace("-", " ") + f" {major}" + (f" {minor}" if minor not in ("", "0") else "(?: 0)?")
            add(numbered, "spdx license identifier " + spdx, label.split("-")[0], 0, 1.0)
        for name in names:
            add(label, name, plain(name), 2, 0.7)
        for verb in VERBS:
            add(label, f"{verb} under(?: the)?(?: terms of)?(?: the)? {every}", "under", 2, 0.8)
        add(label, "spdx license identifier " + label.replace("-", " "), label.split("-")[0], 0, 1.0)
    for label, pattern, keyword, priority, confidence in NOTICES:
        add(label, pattern, keyword, priority, confidence)
    return [{"rule": i, **r} for i, r in enumerate(out)]


def _rule_map() -> Column:
    """first word -> its rules, as one constant."""
    by = defaultdict(list)
    for r in rules():
        by[r["first"]].append({k: r[k] for k in ("rule", "label", "base", "priority", "confidence", "keyword", "pattern")})
    kind = ("map<string,array<struct<rule:int,label:string,base:boolean,priority:int,confidence:double,keyword:string,"
            "pattern:string>>>")
    return F.from_json(F.lit(json.dumps(by)), kind)


def folded(text: Column) -> Column:
    """The words of a text with one blank between them, case as it is."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, " "))


def _detections(words: Column) -> Column:
    """Sorted array of start, -end, priority, rule, label, base, confidence."""
    blanks = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))

    def at_place(place):
        def tried(window):
            likely = F.filter(F.element_at(_rule_map(), place["w"]), lambda r: F.contains(window, r["keyword"]))
            found = F.transform(likely, lambda r: F.struct(
                place["i"].alias("start"), (-place["i"] - blanks(F.call_function("regexp_extract", window, r["pattern"], F.lit(1)))).alias("end"),
                r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label"),
                r["base"].alias("base"), r["confidence"].alias("confidence")))
            return F.filter(found, lambda d: -d["end"] > d["start"])
        text = F.concat(F.lit(" "), F.array_join(F.slice(words, place["i"] + 1, SPAN), " "), F.lit(" "))
        return let(text, tried)

    places = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                      lambda p: F.map_contains_key(_rule_map(), p["w"]))
    return F.sort_array(F.flatten(F.transform(places, at_place)))


def _kept(detections: Column) -> Column:
    """Struct of labels and score of the detections that no other contains.

    In this order a container comes before what it contains.  ``reach`` holds
    how far the detections of each priority or better have reached.
    """
    none = F.struct(F.array(*[F.lit(-1)] * 3).alias("reach"), F.array().cast("array<string>").alias("labels"),
                    F.lit(0.0).alias("score"))

    def step(a, d):
        end, p = -d["end"], d["priority"]
        reach = F.transform(a["reach"], lambda r, k: F.when(k >= p, F.greatest(r, end)).otherwise(r))
        new = F.struct(reach.alias("reach"), F.array_union(a["labels"], F.array(d["label"])).alias("labels"),
                       F.greatest(a["score"], d["confidence"]).alias("score"))
        return F.when(end <= F.get(a["reach"], p), a).otherwise(new)

    return F.aggregate(F.filter(detections, lambda d: ~d["base"]), none, step)


def scan(text: Column) -> Column:
    """Struct of n_words, n_base, first_word, last_word, base_labels, labels, score, detections of a whole text."""
    kind = "array<struct<start:int,end:int,priority:int,rule:int,label:string,base:boolean,confidence:double>>"

    def result(words):
        low = F.concat(F.lit(" "), F.lower(words), F.lit(" "))
        gate = F.lit(False)
        for k in KEYWORDS:
            gate |= F.contains(low, F.lit(k))
        n_words = F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1)
        found = F.when(gate, let(F.split(lower_ascii(words), " "), _detections)).otherwise(F.array().cast(kind))

        def summary(all_):
            base = F.filter(all_, lambda d: d["base"])

            def with_kept(k):
                base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda d: d["label"])))
                labels = F.array_sort(F.array_union(base_labels, k["labels"]))
                places = F.transform(base, lambda d: d["start"].cast("long"))
                return F.struct(
                    n_words.cast("long").alias("n_words"), F.size(base).cast("long").alias("n_base"),
                    F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
                    F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                    F.greatest(k["score"], F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"),
                    F.transform(all_, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("end"),
                                                         d["rule"].alias("rule"), d["label"].alias("label"))).alias("detections"))
            return let(_kept(all_), with_kept)
        return let(found, summary)

    return let(folded(text), result)


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the fields of ``scan`` for each row.

    Null and empty texts have no words and no detections.  Repeated rows are
    scanned alike; an empty table gives no rows; other columns aren't read.
    """
    return docs.select(quoted(doc_id).alias("doc_id"), F.inline(F.array(scan(quoted(text)))))


def oracle() -> str:
    """The same in SQL, with the rules as a table and containment by a running maximum."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({r['rule']}, {text(r['label'])}, {str(r['base']).lower()}, {r['priority']}, {r['confidence']}::DOUBLE, "
                       f"{text(r['keyword'])}, {text(r['first'])}, {text(r['pattern'])})" for r in rules())
    gate = " OR ".join(f"contains(' ' || lower(f) || ' ', {text(k)})" for k in KEYWORDS)
    before = ("max(\"end\") FILTER (WHERE priority <= {p}) OVER (PARTITION BY rid ORDER BY start, \"end\" DESC, priority, rule "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return rf"""
WITH rules(rule, label, base, priority, confidence, keyword, first, pattern) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             trim(regexp_replace(coalesce(text, ''), '{SEPARATORS}', ' ', 'g'), ' ') AS f FROM documents),
g AS (SELECT rid, string_split(translate(f, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ') AS ws FROM d WHERE {gate}),
p AS (SELECT rid, i, ws[i + 1] AS w, ws FROM (SELECT rid, ws, unnest(range(0, len(ws))) AS i FROM g)),
x AS (SELECT rid, i, ' ' || array_to_string(ws[i + 1:i + {SPAN}], ' ') || ' ' AS window_, rules.*
      FROM p JOIN rules ON p.w = rules.first),
m AS (SELECT *, regexp_extract(window_, pattern, 1) AS hit FROM x WHERE contains(window_, keyword)),
h AS (SELECT *, i AS start, i + length(hit) - length(replace(hit, ' ', '')) AS "end" FROM m WHERE hit <> ''),
c AS (SELECT *, {', '.join(before.format(p=p) + f' AS reach_{p}' for p in range(3))} FROM h WHERE NOT base),
k AS (SELECT rid, list_distinct(list(label)) AS labels, max(confidence) AS score FROM c
      WHERE "end" > coalesce(CASE priority WHEN 0 THEN reach_0 WHEN 1 THEN reach_1 ELSE reach_2 END, -1) GROUP BY rid),
b AS (SELECT rid, count(*) AS n, min(start) AS lo, max(start) AS hi, list_distinct(list(label)) AS labels FROM h WHERE base GROUP BY rid)
SELECT d.doc_id, CASE WHEN f = '' THEN 0 ELSE len(string_split(f, ' ')) END::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base,
       b.lo::BIGINT AS first_word, b.hi::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(k.labels, [])))), ','), '') AS labels,
       greatest(coalesce(k.score, 0.0::DOUBLE), CASE WHEN b.n > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) AS score
FROM d LEFT JOIN b ON d.rid = b.rid LEFT JOIN k ON d.rid = k.rid"""
