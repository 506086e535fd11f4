"""The filter audit, fill-in-the-middle and web archives against brute force."""

import gzip
import hashlib
import io
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerloom.llm import fill_middle, filter_audit, warc

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
TEXT = st.text(alphabet=st.one_of(st.sampled_from(WHITE + "abZ<PSM>#é\x1c\x85　"),
                                  st.characters(exclude_categories=["Cs"])), max_size=80)


# --- filter audit --------------------------------------------------------------------------


def brute_audit(masks, n):
    """Every order by going through the masks again."""
    out = {}
    total = [0] * n
    for order in itertools.permutations(range(n)):
        for step, v in enumerate(order):
            before = [m for m in masks if not any(m >> u & 1 for u in order[:step])]
            gone = [m for m in before if m >> v & 1]
            out[order, step + 1] = (
                [sum(masks[m][i] for m in before if not m >> v & 1) for i in range(3)],
                [sum(masks[m][i] for m in gone) for i in range(3)],
                sum(masks[m][0] for m in masks if m >> v & 1) - sum(masks[m][0] for m in gone),
                masks.get(1 << v, (0,))[0])
            total[v] += sum(masks[m][0] for m in gone)
    return {k: (*x, total[k[0][k[1] - 1]]) for k, x in out.items()}


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 5).flatmap(lambda n: st.tuples(st.just(n), st.dictionaries(
    st.integers(0, 2**n - 1), st.tuples(st.integers(1, 9), st.integers(0, 3), st.integers(0, 3)), min_size=1))))
def test_diagram_equals_going_through_the_masks(case):
    n, masks = case
    found = {(order, step): (list(kept), list(removed), redundant, alone, total)
             for order, step, kept, removed, redundant, alone, total in filter_audit.audit_part(masks, n)}
    assert found == brute_audit(masks, n)


@pytest.mark.parametrize("n", range(7))
def test_swaps_lead_through_all_orders(n):
    order, seen = list(range(n)), set()
    for at in [None, *filter_audit.plain_changes(n)]:
        if at is not None:
            order[at], order[at + 1] = order[at + 1], order[at]
        seen.add(tuple(order))
    assert seen == set(itertools.permutations(range(n)))


def test_equal_parts_of_a_diagram_are_one_node():
    every = {mask: (1, 0, 0) for mask in range(32)}
    diagram = filter_audit.Diagram(every, 5)
    assert [len(level) for level in diagram._levels] == [1] * 6
    for at in filter_audit.plain_changes(5):
        diagram.swap(at)
        assert [len(level) for level in diagram._levels] == [1] * 6


def mask_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
             100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)))
    return sum(1 << bit for bit, failed in enumerate(fails) if failed)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_failures_of_one_text(text):
    assert filter_audit.text_failures(text.encode()) == mask_of(text)


def test_words_of_a_long_text_are_counted_by_pieces():
    rng = random.Random(3)
    text = "".join(rng.choice("ab \n\té") for _ in range(5000))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    for piece in (1, 7, 100, 10_000):
        assert filter_audit.word_counts(text.encode(), piece) == (len(words), len(set(words)))
    assert filter_audit.word_counts(b"x" * 3000, 10) == (1, 1)


def audit_rows():
    long = " ".join(f"w{n}" for n in range(250))
    return [(1, long, "a"), (2, long, "a"), (2, long, "a"), (3, long, "b"), (4, None, "a"), (5, "", None),
            (None, long, "b"), (None, long, "b"), (6, "word " * 300, "b"), (7, long + " A$", ""),
            (8, "UPPER " * 300, "b"), (9, "x", None), (9, "y", "a"), (10, long + " $", "b"), (0, long + " $", "a")]


def test_audit_of_odd_documents(spark):
    rows = audit_rows()
    docs = spark.createDataFrame([(i, t, s, "clash", 1, 2) for i, t, s in rows],
                                 "doc_id long, text string, source string, part string, mask int, good int")
    marks = {1: (1, 0), 2: (1, 1), 4: (0, 1), 9: (1, 0), 10: (1, 1)}
    labels = spark.createDataFrame([(i, q, t, "x") for i, (q, t) in marks.items()] + [(None, 1, 1, "x"), (1, 0, 0, "x"), (3, None, None, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    found = filter_audit.filter_audit(docs, labels).collect()
    for part in ("", "a", "b"):
        masks = {}
        for i, t, s in rows:
            if (s or "") != part:
                continue
            copies = [j for j, u, _ in rows if (u or "") == (t or "") and j is not None and i is not None and j < i]
            mask = mask_of(t or "") | (16 if copies else 0)
            n, good, toxic = masks.get(mask, (0, 0, 0))
            q, x = marks.get(i, (0, 0))
            masks[mask] = (n + 1, good + q, toxic + x)
        want = brute_audit(masks, 5)
        own = {(tuple("ABCDE".index(c) for c in r.filter_order), r.step):
               ([r.kept, r.good_lost, r.toxic_lost], r.removed, r.redundant, r.unique_fails, r.shapley)
               for r in found if r.part == part}
        assert own == {k: ([kept[0], removed[1], removed[2]], removed[0], redundant, alone, total)
                       for k, (kept, removed, redundant, alone, total) in want.items()}
    assert len(found) == 3 * 120 * 5
    assert filter_audit.filter_audit(docs.limit(0), labels).collect() == []
    alone = filter_audit.filter_audit(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(alone) == (0, 0)


# --- fill in the middle --------------------------------------------------------------------


def tokens(text):
    return re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)


def lines(text):
    return re.findall("[^\x0a-\x0d]*[\x0a-\x0d]|[^\x0a-\x0d]+$", text)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_cuts_lie_at_the_borders_of_tokens_and_lines(text):
    for unit, split in (("token", tokens), ("line", lines)):
        units, cutter = split(text), fill_middle.Cutter(text, unit)
        assert "".join(units) == text and cutter.units == len(units)
        assert [cutter.after(n) for n in range(len(units) + 1)] == [
            len("".join(units[:n])) for n in range(len(units) + 1)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300))
def test_ranks(symbols):
    matrix = fill_middle.WaveletMatrix(np.array(symbols, np.uint8), 3)
    for symbol in range(8):
        for end in (0, 1, 63, 64, 65, 128, len(symbols)):
            if end <= len(symbols):
                assert matrix.rank(symbol, end) == symbols[:end].count(symbol)


def brute_middle(doc_id, text):
    groups = [int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[at:at + 8], 16) for at in range(0, 32, 8)]
    units = tokens(text)
    if not text or re.search("<[PSM]>", text) or groups[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted(g % (len(units) + 1) for g in groups[:2])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if groups[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transformed_documents_and_back(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "\n\n", "one", "<P> in it", "a <M", "ends <", "<S", "<P", "é 日本　語 x ",
             "word " * 40_000, "x" * 100_000]
    texts += ["".join(rng.choice("ab<PSM> \n\té") for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = [(n, t, "clash", n) for n, t in enumerate(texts)] + [(7, "ends <", "clash", 0)] * 2 + [(None, "a b c", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    found = fill_middle.fill_in_middle(docs).withColumn(
        "back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows)
    want = {(i, t or ""): brute_middle("" if i is None else i, t or "") for i, t, *_ in rows}
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want[r.doc_id, r.back]
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).collect() == []
    by_line = fill_middle.fill_in_middle(docs, unit="line", percent=100, suffix_first=0)
    assert {r.form for r in by_line.collect()} == {"plain", "psm"}


# --- archives ------------------------------------------------------------------------------


def scan(data, edges, keep=True):
    file = io.BytesIO(data)
    return [(r.offset, r.headers.get("warc-page-id"), r.payload) for start, end in zip(edges, edges[1:])
            for r in warc.records_in_range(file, start, end, len(data), keep)]


def archive(payloads):
    return [warc.member(warc.page_record(n, None, p, hashlib.sha256(p).hexdigest(), None))
            for n, p in enumerate(payloads)]


def test_every_cut_gives_every_record_once():
    rng = random.Random(1)
    payloads = [b"", b"x", rng.randbytes(3000), b"<p>text</p>" * 400, b"\x1f\x8b\x08" * 50, rng.randbytes(70_000),
                b"\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab"]
    members = archive(payloads)
    data = b"".join(members)
    want = [(sum(map(len, members[:n])), str(n), p) for n, p in enumerate(payloads)]
    assert scan(data, [0, len(data)]) == want
    for step in (1009, 4096, 65_536):
        assert scan(data, [*range(0, len(data), step), len(data)]) == want
    for cut in range(0, 2000, 7):
        assert scan(data, [0, cut, len(data)]) == want
    assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID") == len(payloads)


def test_long_payloads_are_decoded_in_pieces():
    payload = b"".join(b"%d " % n for n in range(1_200_000))
    data = b"".join(archive([payload, b"next"]))
    (one, two) = warc.records_in_range(io.BytesIO(data), 0, len(data), len(data))
    assert (one.payload, one.payload_bytes, one.payload_sha256) == (None, len(payload), hashlib.sha256(payload).hexdigest())
    assert two.payload_bytes == 4


def test_false_magic_and_foreign_members_are_passed_over():
    inner = b"".join(archive([b"inner"]))
    members = archive([inner, gzip.compress(b"no record"), b"end"])
    junk = gzip.compress(b"plain text") + b"\x1f\x8b\x08 noise" + gzip.compress(b"WARC/1.1\r\nno length\r\n\r\n")
    data = junk + members[0] + junk + members[1] + members[2] + junk
    want = [inner, gzip.compress(b"no record"), b"end"]
    for cut in range(len(data)):
        assert len(scan(data, [0, cut, len(data)])) == 3
    assert [p[:9] for _, _, p in scan(data, [0, len(data)])] == [p[:9] for p in want]


def test_a_stored_member_inside_a_payload_is_coded_again():
    random_part = random.Random(2).randbytes(200_000)
    inner = warc.member(warc.record([("WARC-Type", "resource")], random_part))
    data = b"".join(archive([inner * 3]))
    for step in (1000, 30_011):
        assert len(scan(data, [*range(0, len(data), step), len(data)])) == 1


def test_damage_is_an_error():
    data = archive([random.Random(4).randbytes(50_000)])[0]
    with pytest.raises(warc.DamagedRecord):
        scan(data[:-30_000], [0, len(data) - 30_000])
    with pytest.raises(warc.DamagedRecord):
        scan(data[:30_000] + b"\0" * 50 + data[30_050:], [0, len(data)])


def page_rows():
    page = "<p>" + "long enough a page " * 10 + "</p>"
    rows = [(n, f"http://h/{n}", page) for n in range(5, 60)] + [(3, None, page + "é"), (4, "u\r\nX: y", page + "é")]
    rows += [(100 + n, "http://short", "short") for n in range(5)] + [(200, None, None), (201, None, ""), (5, "http://h/5", page)]
    rows += [(300, "", "é" * 50), (301, "", "é" * 50), (302, "", "x" * 99), (303, "", "x" * 99)]
    rows += [(None, "http://null", page), (None, None, "only null ids " * 20), (None, None, "only null ids " * 20)]
    return rows


def test_pages_written_and_read_back(spark, tmp_path):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "clash", "c") for r in rows],
                                  "page_id long, url string, html string, digest string, key string")
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        holder = first.get(h)
        of = holder if holder is not None and holder != i else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if of is None else "revisit", of))
    got = warc.archive_round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))

    manifest = warc.write_archives(pages, str(tmp_path / "small"), archive_bytes=2000)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 1
    for size in (500, 1 << 20):
        read = warc.read_archives(manifest, range_bytes=size, task_bytes=4000).collect()
        pages_read = [r for r in read if r.record_type != "warcinfo"]
        assert len(pages_read) == len(rows)
        texts = {r.page_id: r.payload.decode() for r in pages_read if r.record_type == "response"}
        assert texts[3] == rows[55][2] and 4 not in texts
        assert texts[300] == "é" * 50 and texts[200] == ""
    urls = {r.page_id: r.url for r in pages_read}
    assert urls[4] == "u%0D%0AX: y" and urls[3] is None and urls[300] == ""
    none = warc.archive_round_trip(pages.limit(0))
    assert none.collect() == []


def test_revisits_without_their_response(spark):
    schema = warc._RECORD_DDL
    records = spark.createDataFrame(
        [("f", 0, "<r1>", "revisit", 7, None, "<gone>", "abc", 0, "e3", None)], schema)
    (row,) = warc.resolved(records).collect()
    assert (row.page_id, row.payload_bytes, row.payload_digest, row.refers_to) == (7, None, "abc", None)


def test_ranges_cover_every_byte(spark):
    files = spark.createDataFrame([("a", 10), ("b", 0), ("c", 21)], "path string, bytes long")
    found = sorted((r.path, r.start, r.end, r.size) for r in warc.byte_ranges(files, 10).collect())
    assert found == [("a", 0, 10, 10), ("c", 0, 10, 21), ("c", 10, 20, 21), ("c", 20, 21, 21)]
