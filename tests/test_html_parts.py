"""Html is parsed in parts of bounded size, whatever the batch."""

import pyarrow as pa

from linkledger.operators import html_profile


def test_html_of_a_batch_is_parsed_in_parts():
    html = ["x" * n for n in (10, 10, 10, 500, 0, 30)] + [None, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(html))), pa.array(html)], names=["k", "html"])
    got = [p.column("k").to_pylist() for p in html_profile.parts(batch, "html", most=30)]
    assert got == [[0, 1, 2], [3], [4, 5, 6], [7]]
    assert list(html_profile.parts(batch.slice(0, 0), "html", most=30)) == []


def test_profiles_are_those_of_each_page(spark, monkeypatch):
    monkeypatch.setattr(html_profile, "PARSED_AT_ONCE", 100)
    pages = [(k, f"u{k}", None if k == 7 else f"<title>t{k}</title><body><div><a href='/{k}'>l</a></div><h1>h{k}</h1>" + "w " * k)
             for k in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    got = {r["page_id"]: r.asDict(recursive=True) for r in html_profile.profile_pages(df, ["page_id", "url"]).collect()}
    assert got == {k: {"page_id": k, "url": u} | html_profile.profile_html(h) for k, u, h in pages}
