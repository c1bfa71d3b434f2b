import hashlib
import random

import pytest

from voltide.llm import warc
from voltide.session import staging_path

PAGES = "page_id long, url string, html string"


def rows():
    long = "<html>" + "körper " * 40 + "</html>"
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb" + "x" * 120
    return [
        (1, "http://www.example.org/b?x=1", long),
        (2, "https://Example.org:8080/a", long),
        (3, None, None),
        (4, "http://a.example.org/", ""),
        (5, "http://a.example.org/", "short"),
        (6, "http://a.example.org/", "short"),
        (7, "http://[broken", tricky),
        (8, "line\r\nbreak", tricky),
        (None, "http://example.org/b", long),
        (9, "", "\r\n\r\n" * 60),
        (9, "", "\r\n\r\n" * 60),
        (10, "http://example.org/big", "𝄞" * 200_000),
    ]


def expected(pages):
    payloads = [(p, (html or "").encode()) for p, _, html in pages]
    first = {}
    for page, data in payloads:
        if page is not None and len(data) >= 100:
            first[data] = min(first.get(data, page), page)
    out = []
    for page, data in payloads:
        refers = first.get(data) if len(data) >= 100 and page != first.get(data) else None
        kind = "response" if refers is None else "revisit"
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return sorted(out, key=repr)


def test_round_trip(frame):
    got = warc.round_trip(frame(rows(), PAGES)).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=repr) == expected(rows())
    ordered = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in ordered] == list(range(len(got)))
    keys = [warc.sort_key(r.asDict()) for r in ordered]
    assert keys == sorted(keys)
    urls = {r.page_id: r.url for r in got}
    assert urls[3] is None and urls[8] == "line%0D%0Abreak" and urls[7] == "http://[broken"


def test_archives_hold_records_of_the_declared_form(frame, spark, tmp_path):
    import gzip

    path = warc.write_archives(frame(rows()[:3], PAGES), f"file://{tmp_path}/archives", records_per_file=1)
    held = [gzip.decompress(f.read_bytes()) for f in sorted(tmp_path.glob("archives/part-*.gz"))]
    held = [data for data in held if data]  # a part without rows gives an empty file
    assert len(held) == 3
    data = held[0]
    head, _, rest = data.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest.endswith(b"\r\n\r\n")
    length = int(head.split(b"Content-Length: ")[-1])
    assert len(rest) == length + 4
    entries = warc.read_archives(spark, path).collect()
    assert len({e.archive for e in entries}) == 3 and all(e.place == 0 for e in entries)


def test_a_changed_payload_is_noticed():
    text = "WARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Payload-Digest: sha256:00\r\nX-Payload-Length: 1"
    with pytest.raises(ValueError, match="does not hold"):
        warc.parse(text, b"HTTP/1.1 200 OK\r\n\r\na")


def test_loser_tree_merges_any_runs():
    random_ = random.Random(2)
    for k in range(12):
        runs = [sorted((random_.randint(0, 20), r, i) for i in range(random_.choice([0, 1, 5, 30]))) for r in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(sum(runs, []))


def test_a_hot_address_is_cut_into_ranges(frame, spark):
    pages = [(k, "http://hot.example.org/", f"page {k}") for k in range(300)]
    path = warc.write_archives(frame(pages, PAGES, partitions=6), staging_path(spark, "archives"))
    found = warc.merged_index(warc.read_archives(spark, path), ranges=4).collect()
    assert [r.page_id for r in sorted(found, key=lambda r: r["rank"])] == list(range(300))
    assert len({r.part for r in found}) > 1


def test_url_keys():
    assert warc.url_key("https://www.Example.org/A?b=C#d") == "org,example)/a?b=c"
    assert warc.url_key("http://example.org:8080") == "org,example:8080)/"
    assert warc.url_key(None) == warc.url_key("") == ""


def test_other_columns_and_empty_tables(frame):
    docs = frame([(1, "u", "a", 5)], f"{PAGES}, payload_digest int")
    assert warc.round_trip(docs).count() == 1
    assert warc.round_trip(frame([], PAGES)).count() == 0
