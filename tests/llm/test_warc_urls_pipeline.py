import gzip
import hashlib
import json
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import urls, warc
from millrace.session import fresh_dir
from tests.conftest import SF
from tests.llm.helpers import awkward

PAGES = "page_id long, url string, html string, records string, path string, refers_to string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "r", "p", "x") for i, u, h in rows], PAGES)


def expected(rows, least=100):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None and len(data) >= least:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        ref = first.get(data) if page_id is not None and page_id != first.get(data) else None
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if ref is not None else "response", ref))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_archives_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(entry.queries()["op9_gzip_normaliser"](spark, SF)) == expected(rows)


def test_archives_of_awkward_pages(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 5</p>" * 40_000
    rows = [(5, "http://a\r\nb", long), (3, None, long), (3, None, long), (9, "u", None), (8, "u", ""), (7, "é", "x" * 99), (6, "é", "x" * 99),
            (2, "q", "é" * 50), (1, "q", "é" * 50), (None, "n", long), (None, None, None)]
    assert found(warc.archive_pages(pages(spark, rows))) == expected(rows)
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_normaliser_makes_members_that_open_alone(spark):
    folder = fresh_dir(spark, "warc-test")
    source = f"{folder}/in.warc.gz"
    wanted = [warc.record(i, "http://x", "response", bytes([65 + i % 7]) * (i * 997), hashlib.sha256(bytes([65 + i % 7]) * (i * 997)).hexdigest(), None) for i in range(300)]
    for pieces in (gzip.compress(b"".join(wanted)), b"".join(gzip.compress(b"".join(wanted[k : k + 7])) for k in range(0, 300, 7))):
        with warc.create(source) as out:
            out.write(pieces)
        archive, sidecar, count = warc.normalise_file(source, folder)
        data = b"".join(warc.pieces_of(archive))
        entries = [json.loads(line) for line in b"".join(warc.pieces_of(sidecar)).splitlines()]
        assert count == 300 and gzip.decompress(data) == b"".join(wanted)
        assert [gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]) for e in entries] == wanted


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=8), st.integers(1, 50))
def test_records_are_cut_whatever_the_pieces(payloads, step):
    wanted = [warc.record(i, None, "response", p, "d", None) for i, p in enumerate(payloads)]
    data = b"".join(wanted)
    assert list(warc.records(data[k : k + step] for k in range(0, len(data), step))) == wanted
    if data:
        with pytest.raises(ValueError):
            list(warc.records(iter([data[:-1]])))


def test_cut_archives_are_errors(spark):
    folder = fresh_dir(spark, "warc-cut")
    wanted = [warc.record(i, "u", "response", bytes([i]) * 5000, "d", None) for i in range(20)]
    packer = zlib.compressobj(6, wbits=31)
    at_edge = packer.compress(b"".join(wanted[:7])) + packer.flush(zlib.Z_SYNC_FLUSH)  # cut at a record's edge
    whole = gzip.compress(b"".join(wanted))
    for name, data, message in (("edge", at_edge, "gzip member"), ("short", whole[:-4], "gzip member"), ("fewer", gzip.compress(b"".join(wanted[:19])), "19 records")):
        with warc.create(f"{folder}/{name}.warc.gz") as out:
            out.write(data)
        with pytest.raises(ValueError, match=message):
            warc.normalise_file(f"{folder}/{name}.warc.gz", folder, 20)
    archives = spark.createDataFrame([(f"{folder}/fewer.warc.gz", 20)], "path string, records long")
    with pytest.raises(Exception, match="19 records"):
        warc.normalise(archives, folder).collect()


def test_folders_are_qualified_on_the_driver(spark):
    rows = [(n, "u", "x" * n) for n in range(30)]
    archives = warc.write_monolithic(warc.classified(pages(spark, rows)), fresh_dir(spark, "warc-names"))
    assert all(r.path.startswith("file:/") for r in archives.collect())


def split_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    tail = rest[end:]
    stop = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def rule_by_hand(host, path):
    best = None
    for rule, verdict in urls.RULES:
        domain, prefix = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best or (None, None)


ODD = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/de/1?x://y", "http://example.net", "http://example.net/EN/", "x://É.NET/a#b?c",
       "http://a.org/fr/1/2/3/4/5/6/7/8/9/10/11", "http://net/", "http://planet/", "http://b.example.com/de", "a://b://c.net/d", "http://h.net?/q", "http://a\n.net/x\ny"]


def test_hosts_paths_and_rules(spark):
    table = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    rows = entry.queries()["op10_path_templates"](spark, SF).collect()
    odd = urls.filter_urls(pages(spark, [(i, u, None) for i, u in enumerate(ODD)])).collect()
    for pairs, got in ((table, rows), (list(enumerate(ODD)), odd)):
        assert len(got) == len(pairs)
        by_id = dict(pairs)
        for r in got:
            host, path = split_by_hand(by_id[r.page_id])
            rule, verdict = rule_by_hand(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule), by_id[r.page_id]
            assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_templates_merge_lookalikes_and_follow_labels(spark):
    rules = (("site.x/bad/1", "block"), ("site.x/good/1", "allow"), ("shop.x/odd/", "block"), ("shop.x/p0/", "allow"), ("shop.x/p1/", "allow"))
    made = [f"http://site.x/{kind}/{n}" for kind in ("bad", "good") for n in range(10, 40)]
    made += [f"http://shop.x/{name}/item" for name in [f"p{chr(97 + i)}" for i in range(26)] + ["p0", "p1"] for _ in range(3)]
    made += ["http://shop.x/odd/item"] * 60
    read = urls.filter_urls(pages(spark, [(i, u, None) for i, u in enumerate(made)]), rules).collect()
    by_url = {made[r.page_id]: r for r in read}
    assert by_url["http://site.x/bad/25"].verdict == "block" and by_url["http://site.x/bad/25"].rule is None
    assert by_url["http://site.x/good/25"].verdict == "allow"
    assert by_url["http://site.x/good/25"].template == "/good/<n>"
    assert by_url["http://shop.x/pq/item"].template == "/<*>/item" and by_url["http://shop.x/pq/item"].verdict == "allow"
    assert by_url["http://shop.x/odd/item"].template == "/odd/item"


def test_verdicts_do_not_turn_on_the_number_of_siblings(spark):
    names = [f"n{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    rules = (("few.x/de/", "block"), ("many.x/de/", "block"), *((f"bad.x/{k}/", "block") for k in "abc"), *((f"mix.x/{k}/", "allow") for k in "abc"), ("mix.x/odd/", "block"))
    made = [f"http://{host}/{name}/p" for host, count in (("few.x", 3), ("many.x", 40)) for name in ["de"] * 20 + names[:count]]
    made += [f"http://{host}/{k}/p" for host in ("bad.x", "mix.x") for k in ["a", "b", "c"] * 10 + ["new"]] + ["http://mix.x/odd/p"] * 10
    rows = urls.filter_urls(pages(spark, [(i, u, None) for i, u in enumerate(made)]), rules).collect()
    got = {made[r.page_id]: r for r in rows}
    for host, count in (("few.x", 3), ("many.x", 40)):  # one labelled branch says nothing about the others
        assert {got[f"http://{host}/{name}/p"].verdict for name in names[:count]} == {"allow"}
        assert got[f"http://{host}/de/p"].template == "/de/p"
    assert got["http://bad.x/a/p"].template == "/<+>/p" and got["http://mix.x/odd/p"].template == "/odd/p"
    assert got["http://bad.x/new/p"].verdict == "block" and got["http://mix.x/new/p"].verdict == "allow"


def test_tokens(spark):
    cases = {"123": "<n>", "123.html": "<n>.html", "2024-01-31": "<date>", "deadbeef01": "<hex>", "deadbeef": "deadbeef", "cafe": "cafe",
             "a-b-1234": "<slug>", "": "", "page2": "page2", "123e4567-e89b-12d3-a456-426614174000": "<uuid>"}
    frame = spark.createDataFrame([(k, v) for k, v in cases.items()], "s string, want string")
    from pyspark.sql import functions as F

    for r in frame.withColumn("got", urls.token(F.col("s"))).collect():
        assert r.got == r.want, r.s
    assert urls.filter_urls(pages(spark, [])).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = corpus_pipeline.stored(docs, "test")
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) == sizes[4] and sorted(r.row_number for r in rows) == list(range(len(rows)))
    hits = entry.queries()["op3_pigeonhole_edits"](spark, SF)
    kept = {r.doc_id for r in rows}
    assert kept.isdisjoint({r.doc_id for r in hits.collect()})
    assert all(r.kept for r in entry.queries()["op1_compression_bands"](spark, SF).collect() if r.doc_id in kept)


def test_pipeline_of_awkward_documents(spark, tmp_path):
    awkward(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0
    awkward(spark).limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
