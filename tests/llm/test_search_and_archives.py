"""Top-k search, archives and decontamination against plain Python."""

import base64
import hashlib
import math

import numpy as np
import pytest
from tideline.llm import decontaminate, topk, warc
from tideline.llm.common import new_folder


def brute_top(rows, queries, k=10):
    def ints(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * float(np.float32(x))) for x in v]

    used: dict[int, list] = {}
    for i, v in rows:
        if i is not None and (q := ints(v)) is not None:
            used[i] = min(used.get(i, q), q)
    out = []
    for q in sorted({i for i, v in queries if i in used and ints(v) is not None}):
        scores = sorted((-sum(a * b for a, b in zip(used[q], v)), i) for i, v in used.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("spread", [1.0, 40.0])
def test_search_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "SHARD", 60)
    monkeypatch.setattr(topk, "BLOCK", 7)
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(0, 1, 24) * spread * (np.arange(24) < 5) + draw.normal(0, 0.1, 24)).tolist()) for i in range(300)]
    rows += [(i + 300, rows[i][1]) for i in range(40)]  # ties
    rows += [(900, None), (901, [None] + [1.0] * 23), (902, [math.inf] * 24), (903, [math.nan] * 24), (None, [1.0] * 24)]
    rows += [(904, []), (905, [1.0, 2.0]), (906, [0.0] * 24), rows[3], (7, [0.5] * 24)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    queries = df.where("vec_id % 10 = 0 OR vec_id IN (901, 904, 905, 7)")
    wanted = [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] in (901, 904, 905, 7))]
    got = sorted(map(tuple, topk.search(df, queries).collect()))
    assert got == brute_top(rows, wanted)


def test_search_of_few_and_of_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.search(df, df).collect())) == [(0, 1, 1, 2**21), (1, 1, 0, 2**21)]
    assert topk.search(df.limit(0), df).count() == 0
    assert topk.search(df, df.where("vec_id = 0")).count() == 1


def test_huge_components_stay_exact():
    vectors = [np.array([2**40, 1]), np.array([2**40, 2]), np.array([-(2**40), 3])]
    dtype = topk._number_type(vectors, vectors, 2)
    assert dtype is object
    ids, score = topk.Postings(np.arange(3), vectors, 2, dtype).search(9, vectors[1].astype(object), 2)
    assert ids.tolist() == [1, 0] and score.tolist() == [2**80 + 4, 2**80 + 2]


PAGES = [
    (1, "http://a/x y", "<p>same</p>"), (5, "http://b/", "<p>same</p>"), (3, None, "<p>same</p>"), (2, "http://c/é", None),
    (4, "http://d/", ""), (6, "http://e/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\nx\r\n\r\n"), (7, "u", "line\nfeed\r\n\r\n"),
    (8, "u", "日本 \U0001f600" * 500), (9, "u", "\r\n\r\n"), (9, "u", "\r\n\r\n"), (None, "v", "<p>same</p>"), (None, "v", "alone"),
]


def test_archives_round_trip(spark):
    df = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, digest string")
    got = sorted((tuple(r)[:5] for r in warc.round_trip(df).collect()), key=str)
    largest: dict = {}
    for page, _, html in PAGES:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if page is None else page)
    wanted = []
    for page, _, html in PAGES:
        raw, top = (html or "").encode(), largest[html or ""]
        revisit = top >= 0 and top != page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        wanted.append((page, len(raw), digest, "revisit" if revisit else "response", top if revisit else None))
    assert got == sorted(wanted, key=str)


def test_payloads_come_back_whole(spark):
    folder = new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string"), folder, records=2)
    got = {r["page_id"]: r["payload"] for r in warc.read_archives(spark, folder, payload=True).collect()}
    assert all(bytes(got[p]) == (h or "").encode() for p, _, h in PAGES if p in (5, 6, 7, 8, 9))


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_legacy_archives_are_converted(spark, tmp_path, version):
    bodies = [b"one", b"two\n\nhttp://x 0.0.0.0 19700101000000 text/html 3\nabc", b""]
    data = warc.arc_start(version) + b"".join(warc.arc_record(version, f"http://p/{n}", 86400 * n, b) for n, b in enumerate(bodies))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/old.arc").write_bytes(data)
    warc.convert_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = sorted(warc.read_archives(spark, str(tmp_path / "out"), payload=True).collect(), key=lambda r: r["url"])
    assert [bytes(r["payload"]) for r in got] == bodies
    assert [r["date"] for r in got] == ["1970-01-01T00:00:00Z", "1970-01-02T00:00:00Z", "1970-01-03T00:00:00Z"]


@pytest.mark.parametrize(
    "data",
    [
        b"http://x 0.0.0.0 19700101000000 text/html 3\nabc\n",
        warc.arc_start(1) + b"http://x 0.0.0.0 19700101000000 text/html 30\nabc\n",
        warc.arc_start(2) + b"http://x 0.0.0.0 19700101000000 text/html 3\nabc\n",
    ],
)
def test_broken_legacy_archives_are_errors(data):
    with pytest.raises(ValueError):
        list(warc.parse_arc(data))


ITEM = "A train leaves at 9 with 120 people and then 30 more get on at the next stop. How many does Maria count if 9 leave?"


def leaks(spark, docs, items):
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, key int")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, h int")
    return {(r[0], r[1]): (round(r[2], 2), r[3]) for r in decontaminate.find(df, bench).collect()}


def test_parameters_are_seen_through(spark):
    other = ITEM.replace("9", "7").replace("120", "44").replace("30", "15").replace("Maria", "Lena")
    mixed = ITEM.replace("at 9", "at 5").replace("if 9", "if 6")  # one number becomes two
    docs = [
        (1, "Some words. " + ITEM + " More words."), (2, "x " * 40 + other), (3, mixed), (4, None), (5, ""),
        (6, "nothing of the kind is in here at all, just 9 and 120 plain words"), (None, ITEM), (1, "again"), (7, ITEM.lower()),
    ]
    got = leaks(spark, docs, [(10, ITEM), (10, ITEM), (11, None), (12, ""), (13, "...")])
    assert {k for k, _ in got} == {1, 2, None, 7} | ({3} if (3, 10) in got else set())
    assert got[(1, 10)][1] is True and got[(2, 10)][1] is False
    assert (3, 10) not in got


def test_units_and_hot_passages(spark):
    item = "boil the water for 10 minutes and then weigh the powder twice before adding 5 kg of salt to the pot"
    docs = [(i, f"doc {i} begins. " + item.replace("10 minutes", f"{i + 20} hours").replace("5 kg", f"{i + 50} g")) for i in range(60)]
    docs += [(i + 100, " ".join(f"w{i}x{j} word" for j in range(40))) for i in range(60)]
    assert {k for k, _ in leaks(spark, docs, [(1, item)])} == set(range(60))


def test_short_items_and_empty_tables(spark):
    assert leaks(spark, [(1, "Just three words"), (2, "just three words more")], [(1, "just three words")]).keys() == {(1, 1)}
    assert leaks(spark, [], [(1, ITEM)]) == {} and leaks(spark, [(1, ITEM)], []) == {}


def test_leaking_documents_go(spark):
    docs = spark.createDataFrame([(1, ITEM, 2), (2, "clean text stays", 3), (None, "no id", 4)], "doc_id long, text string, h int")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(r["h"] for r in decontaminate.without_leaks(docs, bench).collect()) == [3, 4]
