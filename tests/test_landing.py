"""Chart pages and links."""

from pyspark.sql import functions as F

from trendspark.plans import landing

ROW = ("<tr><td> #{r} </td><td><a href=\"/sound/{i}\"><span>Song {i}</span> <small>Artist</small></a></td>"
       "<td>2M\n 2,013,57{i}</td><td>+41,200\n +3.7 %</td><td> EG </td><td>a</td><td>b</td><td>c</td></tr>")


def _page(spark):
    body = "".join(ROW.format(r=i, i=i) for i in range(1, 4))
    short = "<tr><td>#9</td><td><a href=\"/s\">x</a></td><td>1</td></tr>"            # too few cells
    nolink = "<tr>" + "<td>#8</td>" + "<td>no link</td>" * 7 + "</tr>"               # no link in cell 1
    html = (f"<html><body><table><thead><tr><th>h</th></tr></thead><tbody>{body}{short}{nolink}</tbody></table>"
            "<table><tbody>" + ROW.format(r=5, i=5) + "</tbody></table></body></html>")
    detail = ('<a href="/x">x</a><a href="https://www.tiktok.com/music/song-1">m</a>')
    fallback = '<a href="/y">y</a><a href="https://vm.example/abc">View on TikTok</a>'
    return spark.createDataFrame([(1, "https://charts.example.org/list", html),
                                  (2, "https://charts.example.org/sound/1", detail),
                                  (3, "https://charts.example.org/sound/2", fallback),
                                  (4, "https://charts.example.org/sound/3", "<p>none</p>")],
                                 "page_id long, url string, html string")


def test_chart_rows_first_table_only(spark):
    pages = _page(spark)
    rows = landing.html_table_rows(pages.where("page_id = 1"))
    recs = landing.chart_records(landing.chart_cells(rows).withColumn("fetch_timestamp", F.lit("2025-01-01 00:00:00")),
                                 "https://charts.example.org")
    got = sorted((r["rank"], r.sound_name, r.ugc_count, r.growth, r.author_country, r.tokchart_url,
                  r.tiktok_direct_url) for r in recs.collect())
    assert got == [(f"#{i}", f"Song {i}Artist", f"2,013,57{i}", "+41,200", "EG",
                    f"https://charts.example.org/sound/{i}", "Not Found") for i in range(1, 4)]


def test_detail_link_fallbacks(spark):
    pages = _page(spark)
    links = {r.page_id: r.link for r in pages.select("page_id", landing.first_link(F.col("html")).alias("link")).collect()}
    assert links[2] == "https://www.tiktok.com/music/song-1"
    assert links[3] == "https://vm.example/abc"
    assert links[4] is None


def test_chart_records_join_detail_links(spark):
    pages = _page(spark)
    rows = landing.chart_cells(landing.html_table_rows(pages.where("page_id = 1")))
    links = pages.select("url", landing.first_link(F.col("html")).alias("link"))
    recs = landing.chart_records(rows, "https://charts.example.org", links=links)
    got = {r.tokchart_url: r.tiktok_direct_url for r in recs.collect()}
    assert got["https://charts.example.org/sound/1"] == "https://www.tiktok.com/music/song-1"
    assert got["https://charts.example.org/sound/2"] == "https://vm.example/abc"
    assert got["https://charts.example.org/sound/3"] == "Not Found"


def test_page_links_absolute(spark):
    pages = _page(spark)
    out = landing.page_links(pages.where("page_id = 3")).collect()
    assert [(r.pos, r.href, r.text, r.abs_url) for r in out] == [
        (0, "/y", "y", "https://charts.example.org/y"),
        (1, "https://vm.example/abc", "View on TikTok", "https://vm.example/abc")]
