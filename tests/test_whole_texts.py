"""Text queries against brute force over every row and the whole of each text."""

import html
import re
import unicodedata

import duckdb

from strataforge.functions import text as rules
from strataforge.plans import catalogue

SPACE = re.compile(r"[ \t\n\r\f\v]+")


def got(spark, sf, name):
    return sorted(map(tuple, catalogue.QUERIES[name](spark, sf).collect()))


def against_sql(spark, folder, name):
    """The query's rows, once they equal those of its SQL (only for texts that the SQL takes whole)."""
    con = duckdb.connect()
    for table in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}/*.parquet'")
    rows = got(spark, folder, name)
    assert rows == sorted(con.execute(catalogue.SQL[name]).fetchall())
    return rows


def turns(spark, sf):
    return [(r.conv_id, r.turn, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]


def documents(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_arrays_hold_all_tokens_of_a_turn(spark, sf):
    deduped, found = [], []
    for conv, turn, text in turns(spark, sf):
        items = SPACE.sub(" ", text).split(" ")
        first = {}
        for x in items:
            if x:
                first.setdefault(x.lower(), x)
        deduped.append((conv, turn, " ".join(first.values())))
        wrong = {"too_few": len(items) < 3, "too_many": len(items) > 6, "blank_item": "" in items, "repeated_item": len({x.lower() for x in items}) < len(items)}
        found.append((conv, turn, ",".join(k for k, v in wrong.items() if v)))
    assert got(spark, sf, "array_dedupe_fold") == sorted(deduped)
    assert got(spark, sf, "array_checks") == sorted(found)


def test_sets_hold_all_words_of_all_documents(spark, sf):
    def words(text):
        marks = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text)
        return " ".join(sorted({w.lower() for w in marks.split()}))

    assert got(spark, sf, "normalised_sets") == sorted((doc, words(text)) for doc, text in documents(spark, sf))


def test_turns_are_escaped_and_wrapped_to_their_end(spark, sf):
    want = []
    for conv, turn, text in turns(spark, sf):
        x = re.sub("[ \t\n\r\f\v\"']", "_", text) + "x" * 45
        want.append((conv, turn, html.escape(x), "<br>".join(x[i : i + 20] for i in range(0, len(x), 20))))
    assert got(spark, sf, "wrap_and_escape") == sorted(want)


def test_every_document_is_patched_repaired_and_searched(spark, sf):
    docs = documents(spark, sf)
    patched = [(doc, *rules.patch_text(text, [(text[39:51], "EDIT")])) for doc, text in docs]
    assert any(reason == "length out of range" for _, _, reason in patched)
    assert sorted(got(spark, sf, "bounded_patches"), key=repr) == sorted(patched, key=repr)
    old, new = " and the ", " & the "
    reasons = {0: "clause absent", 1: None}
    repaired = [(doc, text.replace(old, new) if text.count(old) == 1 else text, reasons.get(text.count(old), "clause repeated")) for doc, text in docs]
    assert got(spark, sf, "clause_repair") == sorted(repaired)
    term = re.compile(r"(?i)(?<!\w)(?:and|with)(?!\w)")
    assert got(spark, sf, "restricted_terms") == sorted((doc, bool(term.search(text))) for doc, text in docs)


def test_a_turn_without_text_has_no_items(spark, tmp_path):
    turns = spark.createDataFrame([(1, 0, None), (1, 1, ""), (2, 0, " b a B\n")], "conv_id long, turn long, text string")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    assert against_sql(spark, tmp_path, "array_dedupe_fold") == [(1, 0, ""), (1, 1, ""), (2, 0, "b a")]


def test_a_document_without_text_has_no_key(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 b A, b", "en")], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert against_sql(spark, tmp_path, "normalised_sets") == [(1, None), (2, ""), (3, "a b")]
