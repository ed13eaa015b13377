"""Each operator on a table of odd rows and clashing columns, against plain Python."""

import base64
import hashlib
import json
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from medalla.llm import (
    common,
    decontaminate,
    language,
    line_templates,
    near_dups,
    pack,
    quality,
    queries,
    syncmers,
    token_store,
    tool_calls,
    warc,
)
from medalla.llm.tokens import Encoder, default_tokenizer

from . import odd


def rows(df, *key):
    return sorted((tuple(r[c] for c in df.columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return odd.frame(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return odd.frame(spark, []).select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_tokenizer())


# --- helpers -----------------------------------------------------------------


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 9), (9, 8), (500, 7), (3, 3), (60, 61), (61, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    got = dict(rows(common.components(spark.createDataFrame(chain + star, "a long, b long"))))
    want = {i: 100 for i in range(100, 141)} | {7: 7, 8: 7, 9: 7, 500: 7, 60: 60, 61: 60} | {1000 + i: 1000 for i in range(50)}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("k", [0, 1, 37, 99, 100, 500])
def test_mark_first_k(spark, k):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("x"), (F.col("id") % 3).alias("y"))
    kept = [r["x"] for r in common.mark_first_k(df, k, "y", F.col("x").desc()).filter("kept").collect()]
    assert sorted(kept) == sorted(r["x"] for r in df.orderBy("y", F.col("x").desc()).limit(k).collect())
    assert common.mark_first_k(df, k, "x").count() == 100


@pytest.mark.parametrize("bits", [common.MOST_BITS, 6])
def test_without_ids(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "LEAST_BITS", 6)
    monkeypatch.setattr(common, "MOST_BITS", bits)
    df = spark.createDataFrame([(i, i, "x") for i in [*range(300), None, 5]], "doc_id long, word long, bits string")
    ids = spark.createDataFrame([(i,) for i in range(0, 600, 3)], "gone long")
    got = common.without_ids(df, ids)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted([*(i for i in range(300) if i % 3), None, 5], key=str)


# --- 1: line dedup -----------------------------------------------------------


def test_line_dedup(spark, docs):
    out = line_templates.without_recurring_lines(docs).collect()
    passage = odd.prose(2, 60)
    for r in out:
        assert r["dropped"] == ([1] if r["row"]["doc_id"] == 20 else [])  # the passage of document 19
    without = [(d, t.replace(f"{passage}\n", "") if d == 20 else t) for d, t in odd.documents()]
    assert Counter((r["row"]["doc_id"], r["kept_text"]) for r in out) == Counter(without)
    kept = line_templates.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_line_dedup_recurrence(spark):
    head = "This file is covered by the usual terms of the house, see item"
    texts = [f"{odd.prose(50 + i, 30)}\n{head} {i}7\n{odd.prose(80 + i, 30)}" for i in range(6)]
    texts += ["Only this line here.", "Only this line here.", f"{head} 99", "ok", "ok"]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: r for r in line_templates.deduplicated(docs).collect()}
    assert [i for i, r in out.items() if head in r["text"]] == [0]  # digits are variable, document 0 keeps it
    assert 8 not in out  # nothing else was in it
    assert out[6]["text"] == out[7]["text"]  # copies of one text are no recurrence
    assert out[9]["text"] == out[10]["text"] == "ok"
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())


def test_line_dedup_copies_do_not_hide_a_template(spark):
    """Plain Python: a passage in two families stays in the first document's family only."""
    passage, other = odd.prose(300, 60), odd.prose(301, 60)
    text = lambda seed, line: f"{odd.prose(seed, 90)}\n{line}\n{odd.prose(seed + 1, 70)}"
    edited = lambda t, i: " ".join(f"edit{i}" if j == 3 else w for j, w in enumerate(t.split(" ")))
    family = lambda seed, line, n: [text(seed, line)] * (n // 2) + [edited(text(seed, line), i) for i in range(n - n // 2)]
    texts = [text(310 + 2 * i, passage) for i in range(9)] + family(340, passage, 30)  # many copies among the later documents
    texts += family(350, other, 4) + [text(360, other)]  # copies of the document that keeps the line
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts, 1)] + [(None, text(370, other))], "doc_id long, text string")
    for r in line_templates.without_recurring_lines(docs).collect():
        doc = r["row"]["doc_id"]
        assert r["dropped"] == ([] if doc == 1 or doc in range(40, 44) else [1]), doc


def test_line_dedup_short_lines(spark):
    """Plain Python: short lines recur from SHORT_FAMILIES families on, with their fields open."""
    few = line_templates.SHORT_FAMILIES
    place = ["news", "sport", "arts"]
    texts = []
    for i in range(few + 2):
        lines = [odd.prose(400 + i, 40), "Les.", "And ornd.", f"Page {i}", f"Posted by {odd.prose(500 + i, 1)} in {place[i % 3]}", f"{i}"]
        lines += ["Ja.", f"Written by {odd.prose(600 + i, 1)} in {place[i % 3]}"] if i < few - 1 else []
        texts.append("\n".join([*lines, odd.prose(700 + i, 40)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in line_templates.without_recurring_lines(docs).collect():
        doc = r["row"]["doc_id"]
        assert r["dropped"] == ([] if doc == 0 else [1, 2, 3, 4]), doc
        assert r["kept_text"].split("\n") == [x for j, x in enumerate(texts[doc].split("\n")) if j not in r["dropped"]]


def test_line_dedup_empty(empty):
    assert line_templates.deduplicated(empty).count() == 0


# --- 2: decontamination ------------------------------------------------------


@pytest.mark.parametrize("block_windows", [decontaminate.BLOCK_WINDOWS, 15])
def test_decontamination(spark, docs, block_windows):
    base = odd.prose(1, 200).split()
    items = [(1, " ".join(base[40:60])), (2, "TWO, Words!"), (3, None), (4, "..."), (None, "one"), (5, " ".join(base[55:64])), (1, "été")]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(odd.UPPER))
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[i : i + 10]), set()).add("null" if item is None else str(item))
    got = decontaminate.decontaminate(docs, items_df, block_windows=block_windows)
    n = 0
    for r in got.collect():
        text, w = r["row"]["text"] or "", split(r["row"]["text"])
        hit, named = set(), set()
        for window, of in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    named |= of
        assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(named))
        assert [x for s in r["spans"] for x in split(text[s["start"] : s["end"]])] == [w[i] for i in sorted(hit)]
        n += bool(hit)
    assert n == 6
    assert decontaminate.clean(docs, items_df).count() == docs.count() - n


def test_decontamination_empty(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(docs, none).count() == docs.count()
    assert decontaminate.clean(empty, none).count() == 0


# --- 3: syncmers -------------------------------------------------------------


def test_syncmers_against_next(docs):
    distinct = sorted(set(odd.documents()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    nulls = [r for r in distinct if r[0] is None]
    got: dict = {}
    for r in syncmers.against_next(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(odd.documents())
    order = [r for r in distinct if r[0] is not None]
    for i, (doc, text) in enumerate(order):
        text, n = text or "", len(text or "")
        for r in got[doc]:
            follow = [order[i + 1]] if i + 1 < len(order) else nulls  # those without an id are last
            edits = [text[: n - n // 3] + (t or "")[: n // 3] for _, t in follow]
            assert r["n_chars"] == n
            assert r["edited_sha256"] in [hashlib.sha256(e.encode()).hexdigest() for e in edits]
    one = lambda d: got[d][0]
    assert one(16)["fingerprint"] == one(17)["fingerprint"] != one(18)["fingerprint"]
    assert one(17)["near_next"] == 1.0  # its copy
    assert 0.8 < one(18)["near_next"] < 1.0
    assert one(19)["near_next"] == 0.0 and one(21)["near_next"] == 0.0
    assert one(10)["fingerprint"] == one(11)["fingerprint"] == one(12)["fingerprint"] == "" and one(11)["near_next"] == 1.0
    assert 0.3 < one(21)["near_edited"] < 0.7


def test_syncmer_anchors_by_definition(spark):
    text = odd.prose(4, 50)
    got = syncmers.with_anchors(spark.createDataFrame([(text,)], "text string"), "text", "a", k=5, s=2).first()["a"]
    words = spark.createDataFrame([(w,) for w in text.split()], "w string").select(F.xxhash64("w").alias("h"))
    h = [r["h"] for r in words.collect()]
    pairs = [r["p"] for r in spark.createDataFrame(list(zip(h, h[1:])), "a long, b long").select(F.xxhash64("a", "b").alias("p")).collect()]
    want = [i for i in range(len(h) - 4) if min(pairs[i : i + 4]) in (pairs[i], pairs[i + 3])]
    assert [a["position"] for a in got] == want
    shifted = syncmers.with_anchors(spark.createDataFrame([("before it " + text,)], "text string"), "text", "a", 5, 2).first()["a"]
    assert [(a["position"] + 2, a["hash"]) for a in got] == [tuple(a) for a in shifted if a["position"] >= 2]


def test_syncmers_single_and_empty(spark, empty):
    assert syncmers.against_next(empty).count() == 0
    r = syncmers.against_next(odd.frame(spark, [(1, "a b c d e f")])).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"a b c d a b").hexdigest()


# --- 4: near-duplicates ------------------------------------------------------


def _near_case():
    base = odd.prose(30, 120).split()
    texts = list(odd.documents()[:-4])  # ids without repeats
    for i in range(40):  # each a little further from the first: a chain of links
        words = list(base)
        for j in range(i):
            words[j * 3] = f"edit{j}"
        texts.append((100 + i, " ".join(words)))
    common_part = odd.prose(31, 100)
    texts += [(300 + i, f"{common_part} {odd.prose(400 + i, 20 + i)}") for i in range(60)]  # share a passage, some enough of it
    return texts


@pytest.mark.parametrize("most_bits", [common.MOST_BITS, 6])
def test_near_duplicates(spark, monkeypatch, most_bits):
    monkeypatch.setattr(common, "LEAST_BITS", 6)
    monkeypatch.setattr(common, "MOST_BITS", most_bits)  # 6: the bitmap lets everything through
    texts = _near_case()
    want = odd.similar_components(texts)
    got = near_dups.near_duplicates(odd.frame(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(odd.shingles(t)) for d, t in texts}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_odd_rows(docs, empty):
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_dups.near_duplicates(docs).collect())
    assert got[(17, 16, False)] == got[(18, 16, False)] == 1
    assert got[(14, 13, False)] == 1 and got[(10, 10, True)] == 1 and got[(11, 11, True)] == 1
    assert got[(24, 24, True)] == 2 and got[(None, None, True)] == 2
    kept = near_dups.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert near_dups.deduplicated(empty).count() == 0


# --- 5: WARC -----------------------------------------------------------------


@pytest.mark.parametrize("chunk", [warc.CHUNK, 10])
def test_warc_round_trip(spark, chunk):
    big = odd.prose(3, 30_000 if chunk > 10 else 300)
    data = [(1, "http://a/1", big), (0, "http://a/0", big), (2, None, None), (3, "x", ""), (4, "u é\n", "Ünï\r\n\r\ncode"), (5, "y", big)]
    data += [(7, "z", "same"), (7, "z", "same"), (8, "z", "same"), (9, "z", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in data], "page_id long, url string, html string, digest string, length int")
    folder, manifest = warc.write(warc.chunk_table(pages.repartition(3), chunk=chunk))
    chunks = warc.read(spark, folder, manifest, chunk=chunk).cache()
    assert max(len(r["data"]) for r in chunks.collect()) <= chunk
    payloads: dict[int, set] = {}
    for page, _, html in data:
        payloads.setdefault(page, set()).add((html or "").encode())
    whole = chunks.filter("record_type = 'response'").groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "data"))).alias("c"))
    for r in whole.collect():
        if r["page_id"] != 7:  # two records
            assert {b"".join(bytes(c["data"]) for c in r["c"])} == payloads[r["page_id"]]
    first: dict[bytes, int] = {}
    for page in sorted(payloads):
        for p in payloads[page]:
            first.setdefault(p, page)
    want = []
    for page, _, html in data:
        p = (html or "").encode()
        copy = first[p] != page
        want.append((page, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if copy else "response", first[p] if copy else None))
    got = warc.resolved(chunks).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(got) == sorted(want, key=str)


def test_warc_small_payloads_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (None, "d", "long enough")], "page_id long, url string, html string")
    folder, manifest = warc.write(warc.chunk_table(pages, min_bytes=5))
    got = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.resolved(warc.read(spark, folder, manifest)).collect()}
    assert got == {(1, "response", None), (2, "response", None), (3, "response", None), (None, "revisit", 3)}
    folder, manifest = warc.write(warc.chunk_table(pages.filter("page_id > 5")))
    assert warc.resolved(warc.read(spark, folder, manifest)).count() == 0


# --- 6 and 10: token ids -----------------------------------------------------


def test_token_store(spark, docs, empty, encoder):
    folder, manifest = token_store.write(docs)
    got = token_store.read(spark, folder, manifest, with_ids=True).collect()
    at = 0
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted((d for d, _ in odd.documents()), key=lambda d: (d is not None, d or 0))
    want = Counter((d, encoder._ids(t or "") + np.array([2], "<u4").tobytes()) for d, t in odd.documents())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
    for r in ordered:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
    # null and repeated ids are dealt over shards, and the order is kept
    same = odd.frame(docs.sparkSession, [(d, f"t{i} x") for d in (None, 5) for i in range(200)] + [(9, "z")]).repartition(4)
    folder, manifest = token_store.write(same, shard_bytes=1000)
    assert manifest.count() > 4 and manifest.agg(F.max("n_docs")).first()[0] < 150
    back = sorted(token_store.read(spark, folder, manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in back] == [None] * 200 + [5] * 200 + [9]
    folder, manifest = token_store.write(empty)
    assert token_store.read(spark, folder, manifest).count() == 0


def test_packing(docs, empty, encoder):
    got = pack.packed(docs, groups=3).collect()
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    want = Counter((d, encoder._ids(t or "") + bytes(4)) for d, t in odd.documents())
    for (doc, ids), n in want.items():
        cut = [ids[i : i + 8192] for i in range(0, len(ids), 8192)]
        for i, part in enumerate(cut):
            narrow = np.frombuffer(part, "<u4").astype("<u2").tobytes()
            same = [r for r in by_doc[doc] if r["piece"] == i and bytes(r["ids"]) == narrow]
            assert len(same) == n and all(r["start"] == 2048 * i and r["length"] == len(part) // 4 for r in same)
            assert all(r["ids_crc32"] == zlib.crc32(part) for r in same)
    assert len(got) == sum(n * -(-len(ids) // 8192) for (_, ids), n in want.items())
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
        assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= 2048
    assert pack.packed(empty).count() == 0
    assert pack.n_groups(empty) == 1 and pack.n_groups(docs, group_docs=4) == 5 and pack.n_groups(docs, group_bytes=100_000) == 3


# --- 7: language -------------------------------------------------------------


def test_language(spark, empty):
    syllables = {"en": "the and ing tion wh", "de": "der sch ung ein ich", "fr": "eau que les oir é", "es": "ción los que ñ ado"}
    rng = np.random.default_rng(0)
    data = []
    for i in range(240):
        lang = list(syllables)[i % 4]
        parts = syllables[lang].split()
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(40)]
        data.append((i, " ".join(words), lang if i % 7 else None))
    data += [(900, None, "en"), (901, "12 - 34!", "en"), (902, "", "fr"), (903, "²", "fr"), (None, "the and ing", "en"), (5, data[5][1], data[5][2])]
    docs = spark.createDataFrame([(*r, "s", 0.5) for r in data], "doc_id long, text string, lang string, source string, score double")
    held = F.col("doc_id") % 3 == 0
    got = language.predict(docs, held).collect()
    assert len(got) == len(data)
    of = {r["doc_id"]: r for r in got}
    right = [of[i]["lang_pred"] == list(syllables)[i % 4] for i in range(0, 240, 3)]
    assert np.mean(right) > 0.97
    assert all(of[i]["lang_pred"] == "und" and of[i]["score"] == 0 for i in (900, 901, 902, 903))
    assert all(0 <= r["score"] <= 1 for r in got) and of[3]["held_out"] and not of[None]["held_out"]
    # what is held out has no part in it
    other = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    assert rows(language.predict(other, held)) == rows(language.predict(docs, held))
    assert {r["lang_pred"] for r in language.predict(docs.withColumn("lang", F.lit(None).cast("string")), held).collect()} == {"und"}
    only = {r["lang_pred"] for r in language.predict(docs.filter("lang = 'en'"), F.lit(False)).collect()}
    assert only == {"en", "und"}
    assert language.predict(empty, F.lit(False)).count() == 0


# --- 8: tool calls -----------------------------------------------------------

SCHEMAS = {
    "find": {
        "required": ["q"],
        "properties": {"q": {"type": "string", "maxLength": 5}, "n": {"type": "integer", "minimum": 1}, "how": {"enum": ["a", "b"]}},
        "additionalProperties": False,
    },
    "sum": {"properties": {"x": {"type": "array"}, "y": {"type": "number", "maximum": 2.5}}},
}


def test_tool_calls(spark):
    calls = [
        ("c", "1", 1, "find", '{"q":"x","n":2}', ["2"]),  # depends on a later call
        ("c", "2", 2, "sum", '{ "y" : 1.50, "x":[1, {"b":1,"a":null}] }', []),
        ("c", "3", 3, "find", '{"n":0,"how":"c","z":1}', ["1"]),
        ("c", "4", 4, "nope", "{}", ["9"]),
        ("c", "5", 5, "sum", "not json", None),
        ("d", "1", 1, "find", '{"q":"toolong"}', ["2"]),
        ("d", "2", 2, "find", '{"q":7}', ["1"]),  # a cycle
        ("e", "1", 1, "find", '{"q":"a"}', []),
        ("e", "1", 2, "find", '{"q":"b"}', []),  # an id again
        ("e", "2", 3, "find", '{"q":"a"}', []),
        ("e", "2", 3, "find", '{"q":"a"}', []),  # the same row twice
        (None, "1", 1, "find", '{"q":"a"}', []),
        ("f", "1", 1, "sum", None, []),
    ]
    results = [("c", "1", 3, 'say "é"\n'), ("c", "2", 4, None), ("e", "2", 9, "late"), ("e", "2", 8, "early"), ("e", "2", 8, "early"), ("g", "7", 1, "lost"), (None, "1", 1, "x")]
    got = tool_calls.link(
        spark.createDataFrame(calls, "conversation string, call_id string, seq long, name string, arguments string, after array<string>"),
        spark.createDataFrame(results, "conversation string, call_id string, seq long, content string"),
        SCHEMAS,
    )
    of = {(r["conversation"], r["call_id"], r["seq"]): r for r in got.collect()}
    # a row for the result of no call, for each result but the first, and for the one without an identifier
    assert got.count() == len(calls) + 1 + 2 + 1
    assert [json.loads(of["e", "2", n]["message"])["result"] for n in (8, 9)] == ["early", "late"]
    assert all(of["e", "2", n]["errors"] == ["further result"] and of["e", "2", n]["n_results"] == 3 for n in (8, 9))
    assert of["c", "1", 1]["valid"] and of["c", "1", 1]["message"] == '{"arguments":{"n":2,"q":"x"},"id":"1","name":"find","result":"say \\"é\\"\\n"}'
    assert of["c", "2", 2]["message"] == '{"arguments":{"x":[1,{"a":null,"b":1}],"y":1.5},"id":"2","name":"sum","result":null}'
    assert of["c", "2", 2]["valid"] and of["c", "2", 2]["n_results"] == 1
    assert of["c", "3", 3]["errors"] == ["q is missing", "n is below 1", "how is none of the values allowed", "not in the schema: z"]
    assert of["c", "4", 4]["errors"] == ["depends on no call: 9", "unknown function"]
    assert of["c", "5", 5]["errors"] == ["arguments are no JSON object"] and of["f", "1", 1]["errors"] == ["arguments are no JSON object"]
    in_order = sorted((r["delay"], r["seq"], r["call_id"]) for k, r in of.items() if k[0] == "c")
    assert [x[2] for x in in_order] == ["2", "4", "5", "1", "3"]
    assert of["d", "1", 1]["errors"] == ["dependency cycle", "q has more than 5 characters"] and of["d", "1", 1]["delay"] is None
    assert of["d", "2", 2]["errors"] == ["dependency cycle", "q is no string"]
    assert of["e", "1", 1]["valid"] and of["e", "1", 2]["errors"] == ["identifier used before"]
    assert of["e", "2", 3]["errors"] == ["more than one result"] and json.loads(of["e", "2", 3]["message"])["result"] == "early"
    assert of[None, "1", 1]["errors"] == ["no identifier"]
    assert of["g", "7", None]["errors"] == ["no call"] and json.loads(of["g", "7", None]["message"])["result"] == "lost"
    none = spark.createDataFrame([], "conversation string, call_id string, seq long, name string, arguments string, after array<string>")
    assert tool_calls.link(none, spark.createDataFrame([], "conversation string, call_id string, seq long, content string"), SCHEMAS).count() == 0


def test_tool_call_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute("create view conversations as select * from '/root/testdata/sf0.001/conversations.parquet'")
    got = queries.QUERIES["op8_tool_calls"](spark, "/root/testdata/sf0.001")
    cols = ", ".join(got.columns)
    want = con.execute(f"select {cols} from ({queries.SQL['op8_tool_calls']})").fetchall()
    assert rows(got) == sorted(want, key=str) and len(want) >= 48
    assert got.filter("delay = 1").count() > 0


def test_every_turn_is_accounted_for(spark, tmp_path):
    turns = [
        (1, 0, "system", 'Say "é"\n'),
        (1, 1, "user", "what is the time now please"),
        (1, 2, "assistant", "late"),
        (1, 3, "tool", None),
        (1, 4, None, "x"),
        (None, 5, "System", ""),
        (2, 0, "system", None),
        (2, 0, "system", None),
    ]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(path)
    calls, results = tool_calls.turns_as_calls(spark.read.parquet(path))
    others = queries.QUERIES["op8_other_turns"](spark, str(tmp_path))
    assert calls.count() + results.count() + others.count() == len(turns)
    want = [
        (c, t, r, "no call" if r == "system" else "unknown role", json.dumps({"content": x, "role": r}, ensure_ascii=False, separators=(",", ":")))
        for c, t, r, x in turns
        if r not in ("user", "assistant")
    ]
    assert rows(others) == sorted(want, key=str)


# --- 9: quality --------------------------------------------------------------


def _graded():
    rng = np.random.default_rng(2)
    good = lambda i: " ".join("".join(rng.choice(["an", "ther", "ing", "or", "ou", "st"], rng.integers(1, 4))) for _ in range(60))
    data, labels = [], []
    for i in range(900):
        text, kind = good(i), i % 6
        if kind == 4:
            text = text.upper().replace(" ", "!! ")
        if kind == 5:
            words = text.split()
            words[20] = words[40] = "blockhead"
            text = " ".join(words)
        data.append((i, text))
        if i % 2 or i % 3 == 0:
            labels.append((i, int(kind != 4), int(kind == 5)))
    return data, labels


def test_quality(spark, empty):
    data, labels = _graded()
    data += [(2000, None), (2001, ""), (2002, data[0][1]), (0, data[0][1]), (None, data[1][1])]
    docs = odd.frame(spark, data)
    marks = spark.createDataFrame(labels + [(5000, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, marks).collect()
    assert len(got) == len(data)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert np.mean([kept[i] for i in range(900) if i % 6 < 4]) > 0.98
    assert np.mean([kept[i] for i in range(900) if i % 6 >= 4]) < 0.03
    weight = {r["doc_id"]: r["weight"] for r in got}
    assert weight[2000] == weight[2001] == 0 and weight[2002] == weight[0] and max(weight.values()) <= 0
    accepted = quality.accepted(docs, marks)
    assert accepted.columns == docs.columns and accepted.count() == sum(r["kept"] for r in got)
    # without labels, or without bad ones, nothing is rejected
    none = marks.filter("doc_id < 0")
    assert quality.classify(docs, none).filter("not kept").count() == 0
    assert quality.classify(docs, marks.filter("quality = 1 and toxic = 0")).filter("not kept").count() == 0
    assert quality.accepted(empty, marks).count() == 0


def test_quality_decides_by_row(spark):
    data, labels = _graded()
    junk = "!! ".join(data[4][1].split("!! ")[::-1])  # rejected, under an id of a kept text and under none
    data += [(0, junk), (None, junk), (None, data[1][1]), (None, None)]
    docs, marks = odd.frame(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    left = Counter((r["doc_id"], r["text"]) for r in quality.accepted(docs, marks).collect())
    assert left[0, data[0][1]] == left[None, data[1][1]] == left[None, None] == 1
    assert not left[0, junk] and not left[None, junk]
