"""Licence scan by a positional rare-token index (operator 10), in DataFrame
functions alone."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm.common import whole_text

# Fixed by the result contract: what separates words (A-Z count as letters), and
# the base phrases with their labels.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Passages of public licences and their standard headers, as words: label,
# passage, key phrases that must all be there.
PASSAGES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files",
     ("permission is hereby granted free of charge", "associated documentation files")),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software",
     ("permission notice shall be included in all copies or substantial portions of the software",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file "
                 "except in compliance with the license",
     ("apache license version 2 0", "except in compliance with the license")),
    ("apache-2", "apache license version 2 0 january 2004 http www apache org licenses terms and conditions for use "
                 "reproduction and distribution",
     ("apache license version 2 0", "terms and conditions for use reproduction and distribution")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met",
     ("redistribution and use in source and binary forms", "following conditions are met")),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer", ("source code must retain the above copyright notice",)),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission",
     ("endorse or promote products derived from this software",)),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-2", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
              "by the free software foundation either version 2 of the license or at your option any later version",
     ("gnu general public license as published by the free software foundation", "either version 2 of the license")),
    ("gpl-2", "you can redistribute it and or modify it under the terms of the gnu general public license version 2 "
              "as published by the free software foundation", ("gnu general public license version 2 as published",)),
    ("gpl-2", "the licenses for most software are designed to take away your freedom to share and change it",
     ("designed to take away your freedom to share and change it", "version 2 june 1991")),
    ("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
              "by the free software foundation either version 3 of the license or at your option any later version",
     ("gnu general public license as published by the free software foundation", "either version 3 of the license")),
    ("gpl-3", "the gnu general public license is a free copyleft license for software and other kinds of works",
     ("gnu general public license is a free copyleft license",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
             "published by the free software foundation",
     ("gnu lesser general public license as published by the free software foundation",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     ("gnu affero general public license",)),
    ("agpl-3", "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
               "published by the free software foundation either version 3 of the license",
     ("gnu affero general public license as published by the free software foundation",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl "
              "was not distributed with this file", ("mozilla public license v 2 0",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted", ("for any purpose with or without fee is hereby granted",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights",
     ("waived all copyright and related",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0 international",)),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     ("creative commons attribution noncommercial 4 0 international",)),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike 4 0 international",)),
    ("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software released into the public domain",)),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in "
                  "source code form or as a compiled binary for any purpose commercial or non commercial",
     ("copy modify publish use compile sell or distribute this software",)),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
              "software and accompanying documentation covered by this license",
     ("accompanying documentation covered by this license",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
             "held liable for any damages arising from the use of this software",
     ("in no event will the authors be held liable",)),
    ("epl-2", "made available under the terms of the eclipse public license 2 0 which is available at",
     ("eclipse public license 2 0",)),
)
# Words of the identifiers in SPDX lines.
SPDX = (("mit", "mit"), ("apache-2", "apache 2 0"), ("bsd", "bsd 2 clause"), ("bsd-3", "bsd 3 clause"),
        ("gpl-2", "gpl 2 0"), ("gpl-3", "gpl 3 0"), ("lgpl", "lgpl 2 1"), ("lgpl", "lgpl 3 0"), ("agpl-3", "agpl 3 0"),
        ("mpl-2", "mpl 2 0"), ("isc", "isc"), ("cc0", "cc0 1 0"), ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa 4 0"),
        ("unlicense", "unlicense"), ("boost", "bsl 1 0"), ("zlib", "zlib"), ("epl-2", "epl 2 0"))
NOTICES = PASSAGES + tuple((label, f"spdx license identifier {words}", (f"spdx license identifier {words}",))
                           for label, words in SPDX)

RARE_WORDS = 3     # highest-IDF words by which a notice is looked up
LEAST_COVER = 0.5  # least share of a notice's words found at one relative position


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and empty texts have none.  ``lower``
    changes other letters too, but none of these becomes a letter of a template
    (the Kelvin sign becomes k, which no template has)."""
    flat = F.trim(F.regexp_replace(F.lower(whole_text(text)), BETWEEN_WORDS, " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def licence_idf(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """IDF over all documents of every word of the templates: one partial
    aggregation, and as many rows to the driver as the templates have words."""
    vocabulary = sorted({w for _, t, *_ in (*BASE, *NOTICES) for w in t.split()})
    held = F.array_intersect(words_of(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    found = (docs.select(F.explode_outer(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect())
    seen = {r["word"]: r["n"] for r in found}
    total = max(1, docs.count())
    return {w: math.log((1 + total) / (1 + seen.get(w, 0))) for w in vocabulary}


def _rarest(template: list[str], idf: dict[str, float], n: int) -> list[tuple[str, int]]:
    """Up to ``n`` words of the template that occur once in it, rarest first, and
    their positions."""
    once = [(w, i) for i, w in enumerate(template) if template.count(w) == 1]
    return sorted(once, key=lambda p: (-idf[p[0]], p[1]))[:n]


def _literal(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def _templates(idf: dict[str, float]) -> Column:
    """The index of the notices as one constant: label, words, key phrases (as they stand
    between words) and the rarest words with their positions."""
    rows = [{"label": label, "words": notice.split(), "keys": [f" {k} " for k in keys],
             "rare": [{"w": w, "at": at} for w, at in _rarest(notice.split(), idf, RARE_WORDS)]}
            for label, notice, keys in NOTICES]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<label:string,words:array<string>,keys:array<string>,"
                                                "rare:array<struct<w:string,at:int>>>>")


def _starts(spots: str, word, at) -> Column:
    """Where the template would begin for each place of one of its rare words."""
    return F.transform(F.filter(spots, lambda x: x["w"] == word), lambda x: x["i"] - at)


def _cover(words: str, start: Column, template: Column) -> Column:
    """Share of the template's words that stand where it would have them."""
    there = F.slice(F.col(words), F.greatest(start, F.lit(0)) + 1, F.size(template))
    lead = F.array_repeat(F.lit(""), F.greatest(-start, F.lit(0)))
    same = F.zip_with(F.concat(lead, there), template,
                      lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x) / F.size(template).cast("double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_base, first_word,
    last_word, base_labels, labels, score``.

    The index has, for every template (a base phrase or a notice), its rarest
    words by IDF over all documents, with their positions in the template.  A
    file's places of these words are looked up in it; each place says where the
    template would begin.  A base phrase counts where all its words then stand.
    A notice needs two of its rare words to agree on one beginning, half of its
    words at their relative positions and its key phrases in the file.  Votes are
    grouped by sorting, so a text that repeats a notice costs in proportion to its length.

    ``score`` is 1 with a base phrase, else the best share of a notice, else 0.
    Null and empty texts: no words, empty labels, null places, score 0.  Rows are
    independent and nothing is shuffled but the word counts; repeated rows repeat.
    """
    idf = licence_idf(docs, text_col)
    index = {w for _, t in BASE for w, _ in _rarest(t.split(), idf, 1)}
    index |= {w for _, t, _ in NOTICES for w, _ in _rarest(t.split(), idf, RARE_WORDS)}
    rare = _literal(sorted(index))
    no_spots = F.array().cast("array<struct<w:string,i:int>>")
    d = (docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
         .withColumn("spots", F.when(
             F.arrays_overlap("words", rare),
             F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                      lambda x: F.array_contains(rare, x["w"]))).otherwise(no_spots)))
    for label, phrase in BASE:
        t = phrase.split()
        (word, at), = _rarest(t, idf, 1)
        d = d.withColumn(f"at_{label}", _stands(_starts("spots", word, at), t))
    flat = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    d = d.withColumn("flat", F.when(F.size("spots") > 0, flat))
    d = d.withColumn("held", F.when(F.col("flat").isNotNull(), F.filter(
        _templates(idf), lambda t: F.forall(t["keys"], lambda k: F.col("flat").contains(k)))))
    d = d.withColumn("held", F.transform("held", lambda t: F.struct(
        t["label"].alias("label"), t["words"].alias("words"), F.sort_array(F.flatten(F.transform(
            t["rare"], lambda r: _starts("spots", r["w"], r["at"])))).alias("votes"))))
    d = d.withColumn("covers", F.transform("held", lambda t: F.struct(t["label"].alias("label"), F.array_max(
        F.transform(_agreed(t["votes"]), lambda s: _cover("words", s, t["words"]))).alias("c"))))
    no_covers = F.array().cast("array<struct<label:string,c:double>>")
    d = d.withColumn("covers", F.coalesce(F.filter("covers", lambda x: x["c"] >= LEAST_COVER), no_covers))
    places = F.concat(*[f"at_{label}" for label, _ in BASE])
    base = [F.when(F.size(f"at_{label}") > 0, label) for label, _ in BASE]
    join = lambda found: F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ",")
    best = F.coalesce(F.array_max(F.transform("covers", lambda x: x["c"])), F.lit(0.0))
    return d.withColumn("places", places).select(
        F.col("id").alias(id_col), F.size("words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        join(F.array(*base)).alias("base_labels"),
        join(F.concat(F.array(*base), F.transform("covers", lambda x: x["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))


def _stands(starts: Column, template: list[str]) -> Column:
    """The starts at which all words of the template stand."""
    return F.filter(starts, lambda s: (s >= 0) & (F.slice(F.col("words"), F.greatest(s, F.lit(0)) + 1, len(template))
                                                  == _literal(template)))


def _agreed(votes: Column) -> Column:
    """The distinct starts that two rare words or more vote for; ``votes`` are sorted."""
    return F.array_distinct(F.filter(votes, lambda s, i: (i > 0) & (s == F.get(votes, i - 1))))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_words(phrase: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in phrase.split()) + "]"


_SQL_BASE = ", ".join(f"('{label}', {_sql_words(t)})" for label, t in BASE)
_SQL_NOTICES = ", ".join("({}, '{}', {}, [{}])".format(i, label, _sql_words(t), ", ".join(f"' {k} '" for k in keys))
                         for i, (label, t, keys) in enumerate(NOTICES))

OP10_SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b(label, tw) AS (VALUES {_SQL_BASE}),
n(nid, label, tw, needed) AS (VALUES {_SQL_NOTICES}),
places AS (
  SELECT doc_id, label, unnest([i - 1 FOR i IN range(1, len(ws) - len(tw) + 2) IF ws[i:i + len(tw) - 1] = tw]) AS spot
  FROM w, b),
based AS (
  SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word FROM places GROUP BY doc_id),
held AS (SELECT word, count(*) AS c FROM (SELECT doc_id, unnest(list_distinct(ws)) AS word FROM w) GROUP BY word),
tw AS (SELECT nid, unnest(tw) AS word, generate_subscripts(tw, 1) - 1 AS spot FROM n),
once AS (SELECT nid, word, min(spot) AS spot FROM tw GROUP BY nid, word HAVING count(*) = 1),
rare AS (
  SELECT nid, word, spot FROM (SELECT o.nid, o.word, o.spot, row_number() OVER (
    PARTITION BY o.nid ORDER BY coalesce(h.c, 0), o.spot) AS r FROM once AS o LEFT JOIN held AS h ON h.word = o.word)
  WHERE r <= {RARE_WORDS}),
pos AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM w),
votes AS (
  SELECT p.doc_id, r.nid, p.i - r.spot AS s FROM pos AS p JOIN rare AS r ON p.word = r.word
  GROUP BY ALL HAVING count(*) >= 2),
cover AS (
  SELECT v.doc_id, n.label, max(list_sum([CASE WHEN v.s + k >= 1 AND w.ws[v.s + k] = n.tw[k] THEN 1 ELSE 0 END
    FOR k IN range(1, len(n.tw) + 1)])::DOUBLE / len(n.tw)) AS c
  FROM votes AS v JOIN n ON n.nid = v.nid JOIN w ON w.doc_id = v.doc_id
  WHERE len([k FOR k IN n.needed IF NOT contains(' ' || array_to_string(w.ws, ' ') || ' ', k)]) = 0
  GROUP BY v.doc_id, n.label),
found AS (
  SELECT doc_id, label, true AS base, 1.0::DOUBLE AS c FROM places
  UNION ALL SELECT doc_id, label, false, c FROM cover WHERE c >= {LEAST_COVER}),
said AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, max(c) AS score
  FROM found GROUP BY doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(d.n_base, 0) AS n_base, d.first_word, d.last_word,
  coalesce(s.base_labels, '') AS base_labels, coalesce(s.labels, '') AS labels, coalesce(s.score, 0.0) AS score
FROM w LEFT JOIN based AS d ON d.doc_id = w.doc_id LEFT JOIN said AS s ON s.doc_id = w.doc_id
"""
