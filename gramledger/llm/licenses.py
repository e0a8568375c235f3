"""Licence scan by a positional index of rare template words.

The index holds, for every word of the licence templates, the templates and
places it stands in. A file's licence words with the highest IDF (over all
documents) are looked up in it; a template stands where the places of its rarest
key words agree on one offset and every mandatory key phrase is found there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import TERM_BYTES, batch, split_words, utf8

# Base phrases and the labels they stand for.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, template text, mandatory key phrase (part of the text).
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
     "is hereby granted", "modify and or distribute this software"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    key: range  # where the mandatory phrase stands in words
    base: bool = False

    @staticmethod
    def of(label: str, text: str, phrase: str, base: bool = False) -> Template:
        words, part = text.split(), phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(part)] == part)
        return Template(label, tuple(w.encode() for w in words), range(start, start + len(part)), base)


def all_templates() -> list[Template]:
    return [Template.of(label, p, p, base=True) for p, label in BASE.items()] + [Template.of(*t) for t in TEMPLATES]


class Index:
    """Postings of template words, and by which of them a template is looked for.

    A template's anchors are the two rarest different words of its mandatory
    phrase. Every place where the phrase stands has both, so looking up anchors
    alone loses none.
    """

    def __init__(self, templates: list[Template], documents_with: dict[bytes, int]):
        self.templates = templates
        self.words = {w for t in templates for w in t.words}
        self.rarity = {w: (documents_with.get(w, 0), w) for w in self.words}  # rising: falling IDF
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.anchors: list[list[tuple[bytes, int]]] = []
        for k, t in enumerate(templates):
            places = {t.words[i]: i for i in reversed(t.key)}  # the first place of each key word
            chosen = sorted(places, key=self.rarity.__getitem__)[:2]
            self.anchors.append([(w, places[w]) for w in chosen])
            self.postings[chosen[0]].append((k, places[chosen[0]]))

    def alignments(self, words: dict[bytes, list[int]]) -> Iterator[tuple[Template, int, float]]:
        """Template, offset and matched share of its words, where it stands; words: the places of a file's."""
        for rare in sorted(words, key=self.rarity.__getitem__):
            for k, i in self.postings.get(rare, ()):
                t = self.templates[k]
                starts = {p - i for p in words[rare]}
                for other, j in self.anchors[k][1:]:
                    starts &= {p - j for p in words.get(other, ())}
                if not starts:
                    continue
                sets = {w: set(words.get(w, ())) for w in set(t.words)}
                for start in sorted(starts):
                    if all(start + i in sets[t.words[i]] for i in t.key):
                        here = sum(start + i in sets[w] for i, w in enumerate(t.words))
                        yield t, start, here / len(t.words)


def places(text: bytes | None, wanted: set[bytes]) -> tuple[int, dict[bytes, list[int]]]:
    """How many words a text has, and where its licence words stand."""
    n, found = 0, defaultdict(list)
    for words in split_words(text, TERM_BYTES):
        for i, w in enumerate(words, n):
            if w in wanted:
                found[w].append(i)
        n += len(words)
    return n, found


WORD_COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def document_frequencies(docs: DataFrame, text: str, templates: list[Template]) -> dict[bytes, int]:
    """In how many documents each template word stands. As many rows as the templates have words."""
    wanted = {w for t in templates for w in t.words}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        for rows in batches:
            for value in rows.column(0):
                for w in _present(value.as_py(), wanted):
                    counts[w] += 1
        yield batch(WORD_COUNTS, [list(counts), list(counts.values())])

    rows = docs.select(utf8(text).alias("text")).mapInArrow(count, "word binary, n bigint")
    return {bytes(r.word): r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _present(text: bytes | None, wanted: set[bytes]) -> set[bytes]:
    found: set[bytes] = set()
    for words in split_words(text, TERM_BYTES):
        found |= wanted.intersection(words)
    return found


SCANNED = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
     ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def scan_licenses(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", templates: list[Template] | None = None
) -> DataFrame:
    """One row per row of docs: which licences its text names, and where.

    n_words; n_base, first_word, last_word: number, smallest and largest start of the
    base phrases (null without any); base_labels: theirs; labels: also those of
    templates that stand in the text (all distinct, sorted, comma-joined); score: the
    largest share of a template's words found at one of its places, 0 to 1.

    Null and empty texts have no words, score 0 and empty labels. Repeated rows give
    repeated results, a null doc_id stays null. An empty table gives no rows. A place
    that several templates share counts for each. Other columns are not looked at.
    """
    templates = templates or all_templates()
    index = docs.sparkSession.sparkContext.broadcast(Index(templates, document_frequencies(docs, text, templates)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = [[] for _ in range(7)]
            for value in rows.column(1):
                n, found = places(value.as_py(), index.value.words)
                starts, base, more, score = [], set(), set(), 0.0
                for t, start, share in index.value.alignments(found):
                    if t.base:
                        starts.append(start)
                        base.add(t.label)
                    else:
                        more.add(t.label)
                        score = max(score, share)
                values = (n, len(starts), min(starts, default=None), max(starts, default=None),
                          ",".join(sorted(base)), ",".join(sorted(base | more)), score)
                for column, value_ in zip(out, values, strict=True):
                    column.append(value_)
            yield batch(SCANNED, [rows.column(0), *out])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text")).mapInArrow(
        scan, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double"
    )


def oracle_sql(table: str = "documents") -> str:
    """DuckDB SQL for scan_licenses: every place of every template tried."""

    def starts(t: Template) -> str:
        here = " AND ".join(f"i + {k} >= 1 AND w[i + {k}] = '{t.words[k].decode()}'" for k in t.key)
        # i: place (from 1) of the template's first word; may lie before the text
        return f"list_filter(range({1 - t.key.start}, len(w) + 1), lambda i: COALESCE({here}, FALSE))"

    def share(t: Template) -> str:
        one = " + ".join(f"CASE WHEN i + {k} >= 1 AND w[i + {k}] = '{w.decode()}' THEN 1 ELSE 0 END" for k, w in enumerate(t.words))
        return f"COALESCE(list_max(list_transform({starts(t)}, lambda i: ({one}) / {len(t.words)}.0)), 0)::DOUBLE"

    base = [t for t in all_templates() if t.base]
    more = [t for t in all_templates() if not t.base]
    at = "list_concat(" + ", ".join(starts(t) for t in base) + ")"
    named = ", ".join(f"CASE WHEN len({starts(t)}) > 0 THEN '{t.label}' END" for t in base)
    found = ", ".join(f"CASE WHEN {share(t)} > 0 THEN '{t.label}' END" for t in more)
    join = "COALESCE(array_to_string(list_sort(list_distinct(list_filter([{}], lambda x: x IS NOT NULL))), ','), '')"
    return f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(
            translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}),
        s AS (SELECT *, {at} AS starts FROM d)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(starts)::BIGINT AS n_base,
            (list_min(starts) - 1)::BIGINT AS first_word, (list_max(starts) - 1)::BIGINT AS last_word,
            {join.format(named)} AS base_labels, {join.format(named + ', ' + found)} AS labels,
            greatest({', '.join(share(t) for t in more)}) AS score FROM s"""
