import pytest
from pyspark.sql import functions as F

from conftest import rows
from spoorlens.functions import text as t
from spoorlens.operators import manifest
from spoorlens.operators.stops import clean_disruptions, explode_codes
from spoorlens.plans import jobs

PAGE = "https://h.example/a/b/c?q=1#f"


@pytest.mark.parametrize("href,want", [
    ("https://x.example/y", "https://x.example/y"),
    ("//x.example/y", "//x.example/y"),
    ("mailto:a@b", "mailto:a@b"),
    ("/y/z?k=1#m", "https://h.example/y/z?k=1#m"),
    ("y.csv", "https://h.example/a/b/y.csv"),
    ("./y.csv", "https://h.example/a/b/y.csv"),
    ("../y.csv", "https://h.example/a/y.csv"),
    ("../../../y.csv", "https://h.example/y.csv"),
    ("/x/../y", "https://h.example/y"),
    ("..", "https://h.example/a/"),
    (".", "https://h.example/a/b/"),
    ("?k=2", "https://h.example/a/b/c?k=2"),
    ("#top", "https://h.example/a/b/c?q=1#top"),
    ("", PAGE),
])
def test_links_are_resolved(spark, href, want):
    df = spark.createDataFrame([(PAGE, href)], "u string, h string")
    u, h = F.col("u"), F.col("h")
    assert df.select(t.resolve_link(u, t.page_address(u), h)).first()[0] == want


def test_link_on_a_page_without_path(spark):
    df = spark.createDataFrame([("https://h.example", "y")], "u string, h string")
    u, h = F.col("u"), F.col("h")
    assert df.select(t.resolve_link(u, t.page_address(u), h)).first()[0] == "https://h.example/y"


@pytest.mark.parametrize("url,want", [
    ("https://h.example/a/services-2020.csv.gz?v=1#x", "services-2020.csv.gz"),
    ("/a/b;v=1", "b"), ("https://h.example", ""), ("https://h.example/a/", ""), ("name", "name"),
])
def test_file_names(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(t.file_name(F.col("u"))).first()[0] == want


@pytest.mark.parametrize("title,want", [
    ("Kerst (Christmas)", "Christmas"), ("Kerst (Christmas) ", "Christmas"), ("Kerst", "Kerst"),
    (" a (b) c ", "a (b) c"), ("a (b) ( c )", "c"), ("()", "()"), (None, ""),
])
def test_english_names(spark, title, want):
    assert spark.createDataFrame([(title,)], "x string").select(t.english_name(F.col("x"))).first()[0] == want


def test_anchors_of_a_page(spark):
    html = """<!-- <a href="/no">x</a> --><script>var a='<a href="/no">';</script>
      <A class="k" HREF='/one'>1</A><a title="a > b" href="/two?x=1&amp;y=2">2</a><a href=three>3</a>
      <a name="n">no link</a><area href="/no"><a data-href="/no">x</a><a
      href = " /four ">4</a><a title="href=/no" href="/five">5</a>"""
    df = spark.createDataFrame([(1, "https://h.example/d/", html)], "page_id int, url string, html string")
    got = [r.link for r in manifest.page_links(df).orderBy("pos").collect()]
    assert got == ["https://h.example" + p for p in ("/one", "/two?x=1&y=2", "/d/three", "/four", "/five")]


def _pages(spark, *names):
    html = "".join(f'<a href="/f/{n}">x</a>' for n in names)
    return spark.createDataFrame([("https://h.example/", html)], "url string, html string")


def test_manifest_prefers_the_yearly_file(spark):
    pages = _pages(
        spark, "services-2020-02.csv.gz", "services-2020-01.csv.gz", "services-2019.csv.gz", "services-2019-01.csv.gz",
        "services-2018.csv.gz", "disruptions-2020.csv", "disruptions-2011.csv", "xservices-2021.csv.gz",
        "services-2021.csv.gz.bak", "stations-2023-09.csv", "tariff-distances-2022-01.csv", "stations-2022-01.csv",
    )
    assert [(r.dataset, r.file_name) for r in jobs.build_manifest(pages).collect()] == [
        ("services", "services-2019.csv.gz"), ("services", "services-2020-01.csv.gz"),
        ("services", "services-2020-02.csv.gz"), ("disruptions", "disruptions-2020.csv"),
        ("stations", "stations-2023-09.csv"), ("tariff_distances", "tariff-distances-2022-01.csv"),
    ]


def test_manifest_without_a_needed_file(spark):
    with pytest.raises(LookupError, match="services"):
        jobs.build_manifest(_pages(spark, "services-2018.csv.gz", "disruptions-2020.csv"))


def test_code_lists(spark):
    df = spark.createDataFrame([(1, "a, b,,c "), (2, None), (3, "  "), (4, "a b"), (5, ",")], "id int, code string")
    assert rows(explode_codes(df, "code")) == [(1, "A"), (1, "B"), (1, "C"), (4, "AB")]


def test_disruption_copies_go(spark):
    raw = spark.createDataFrame(
        [("a, A", "c", "s", "g", "2024-01-01 00:00:00", ""), ("a", "c", "s", "g", "2024-01-01 00:00:00", None),
         (None, "c", "s", "g", "2024-01-01 00:00:00", "")],
        "rdt_station_codes string, cause_en string, statistical_cause_en string, cause_group string, start_time string, end_time string",
    )
    got = clean_disruptions(raw).collect()
    assert len(got) == 1 and got[0].disruption_station_code == "A" and got[0].disruption_end_time_ts is None
