import random
import re
from collections import deque

from pyspark.sql import functions as F

from builders import HTML, response, responses
from pagemill.operators import boilerplate, links, search, sitemaps
from pagemill.sources.responses import response_documents, with_content


def pages(spark, *rows):
    return with_content(response_documents(responses(spark, *rows)))


def test_link_edges(spark):
    body = (
        '<base href="/docs/"><a href="a.html">A</a><A HREF=../b?x=1&amp;y=2#f>B</A>'
        "<area href='//other.org/c'><a href='mailto:x@y'>m</a><a href=''>self</a>"
        '<a href="/f.PDF">pdf</a><a href="a.html">again</a><!-- <a href="/no"> --><a href=" /é ">e</a>'
    )
    edges = links.link_edges(pages(spark, response(1, "https://Example.com/x", body)))
    assert {(r.link_url, r.target_url) for r in edges.collect()} == {
        ("https://Example.com/docs/a.html", "https://example.com/docs/a.html"),
        ("https://Example.com/b?x=1&y=2#f", "https://example.com/b?x=1&y=2"),
        ("https://other.org/c", "https://other.org/c"),
        ("https://Example.com/docs/", "https://example.com/docs/"),
        ("https://Example.com/%C3%A9", "https://example.com/%C3%A9"),
    }
    inside = links.links_in_scope(edges, ["/docs/"])
    assert {r.target_url for r in inside.collect()} == {
        "https://example.com/docs/a.html", "https://example.com/docs/"
    }
    assert links.links_in_scope(edges, None, "other.org").count() == 1


def test_new_links_first_source_wins(spark):
    body = '<a href="/t">t</a><a href="/known">k</a>'
    edges = links.link_edges(pages(spark, *(response(i, f"https://h/{i}", body) for i in (5, 3, 9))))
    known = spark.createDataFrame([("https://h/known",)], ["url"])
    got = links.new_links(edges, known).collect()
    assert [(r.target_url, r.source_url, r.seq) for r in got] == [("https://h/t", "https://h/3", 3)]


def test_crawl_depth_equals_search(spark):
    dice = random.Random(3)
    edges = [(f"n{dice.randint(0, 30)}", f"n{dice.randint(0, 90)}") for _ in range(120)]
    edges += [("n0", f"leaf{i}") for i in range(60)] + [("n1", "n0"), ("n0", "n1")]
    expected, queue = {"n0": 0}, deque(["n0"])
    while queue:
        node = queue.popleft()
        for source, target in edges:
            if source == node and target not in expected:
                expected[target] = expected[node] + 1
                queue.append(target)
    df = spark.createDataFrame(edges, "source_url string, target_url string")
    seeds = spark.createDataFrame([("n0",)], ["url"])
    assert {r.url: r.depth for r in links.crawl_depth(df, seeds).collect()} == expected
    shallow = {r.url: r.depth for r in links.crawl_depth(df, seeds, 1).collect()}
    assert shallow == {u: d for u, d in expected.items() if d <= 1}


def test_a_level_does_not_move_the_edges(spark, monkeypatch):
    plans, original = [], links.next_level

    def watch(*given):
        df = original(*given)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(links, "next_level", watch)
    monkeypatch.setattr(links, "_LEVELS_PER_CUT", 2)
    monkeypatch.setattr(links, "_EDGES_PER_PART", 200)
    # Far larger than a broadcast takes, so that joins would shuffle.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chain = spark.range(6).select(F.concat(F.lit("c"), "id").alias("s"), F.concat(F.lit("c"), F.col("id") + 1).alias("t"))
        hub = spark.range(500).select(F.lit("c2").alias("s"), F.concat(F.lit("leaf"), "id").alias("t"))
        edges = chain.union(hub).toDF("source_url", "target_url")
        seeds = spark.createDataFrame([("c0",)], ["url"])
        depths = {r.url: r.depth for r in links.crawl_depth(edges, seeds).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert depths == {f"c{i}": i for i in range(7)} | {f"leaf{i}": 3 for i in range(500)}
    assert len(plans) == 7
    for plan in plans:
        # One exchange places the sources of the level, one its targets; neither the edges nor
        # what is reached has one of its own.
        exchanges = re.findall(r"Exchange (hashpartitioning\((?:source_url|url)|\w+)", plan)
        assert sorted(e for e in exchanges if e.startswith("hash")) == [
            "hashpartitioning(source_url", "hashpartitioning(url"
        ]
        assert re.search(r"LeftSemi\n\W*- Scan ExistingRDD\[source_url#\d+,target_url", plan)


def test_sitemaps(spark):
    urlset = (
        '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
        "<url><loc>https://example.com/from-sitemap</loc><lastmod>2020</lastmod></url>"
        "<url><loc> https://example.com/b?x=1&amp;y=2 </loc></url>"
        "<url><loc>https://other.example.com/external</loc></url></urlset>"
    )
    index = "<sitemapindex><sitemap><loc>https://example.com/s.xml</loc></sitemap></sitemapindex>"
    robots = "User-agent: *\nSitemap: /a.xml\n  sitemap: https://EXAMPLE.com/b.xml \nSitemap: https://o.org/c"
    docs = pages(
        spark,
        response(1, "https://example.com/s.xml", urlset, "application/xml"),
        response(2, "https://example.com/i.xml", index, "application/xml"),
        response(3, "https://example.com/bad.xml", "<urlset><url><loc>x</loc>", "application/xml"),
        response(4, "https://example.com/empty.xml", "", "application/xml"),
        response(5, "https://example.com/gone.xml", urlset, "application/xml", status=404),
        response(6, "https://example.com/robots.txt", robots, "text/plain"),
    )
    parsed = sitemaps.parsed_sitemaps(docs.where(F.col("seq") < 6))
    assert {r.target_url for r in sitemaps.sitemap_urls(parsed).collect()} == {
        "https://example.com/from-sitemap", "https://example.com/b?x=1&y=2"
    }
    children = sitemaps.sitemap_children(parsed)
    assert [tuple(r) for r in children.collect()] == [
        (2, "https://example.com/i.xml", "https://example.com/s.xml")
    ]
    found = sitemaps.robots_sitemaps(docs.where(F.col("seq") == 6))
    assert {r.sitemap_url for r in found.collect()} == {
        "https://example.com/a.xml", "https://example.com/b.xml"
    }
    seeds = spark.createDataFrame([("https://example.com/i.xml",)], ["url"])
    reached = {r.url: r.depth for r in sitemaps.reachable_sitemaps(children, seeds).collect()}
    assert reached == {"https://example.com/i.xml": 0, "https://example.com/s.xml": 1}


def test_clean_pages(spark):
    rows = [
        response(i, f"https://h/{i}", f"<p>Share this</p><p>Story {i}</p><p>Share this</p>", HTML)
        for i in range(4)
    ] + [response(9, "https://h/9", "<p>Share this</p>"), response(10, "https://o/1", "<p>Share this</p>")]
    blocks = boilerplate.page_blocks(pages(spark, *rows))
    repeated = boilerplate.boilerplate_blocks(blocks, 2).collect()
    assert [(r.host, r.block, r.pages) for r in repeated] == [("h", "Share this", 5)]
    expected = {**{i: (f"Story {i}", 2) for i in range(4)}, 9: ("Share this", 0), 10: ("Share this", 0)}
    for stored in (None, boilerplate.boilerplate_blocks(blocks, 2)):
        cleaned = boilerplate.clean_pages(blocks, stored, 2).collect()
        assert {r.seq: (r.text, r.dropped) for r in cleaned} == expected


def test_boilerplate_is_a_share_of_the_pages_of_a_host(spark):
    def pages_of(host, count, repeats):
        return [
            response(1000 * repeats + i, f"https://{host}/{i}", f"<p>Own {i}</p>" + "<p>Said thrice</p>" * (i < repeats), HTML)
            for i in range(count)
        ]

    # 3 of 29 pages are 10.3 %, 4 of 30 are 13.3 %.
    blocks = boilerplate.page_blocks(pages(spark, *pages_of("small", 29, 3), *pages_of("large", 30, 4)))
    rows = boilerplate.boilerplate_blocks(blocks).collect()
    assert sorted((r.host, r.pages) for r in rows) == [("large", 4), ("small", 3)]
    rows = boilerplate.boilerplate_blocks(blocks, percent=11).collect()
    assert [(r.host, r.pages) for r in rows] == [("large", 4)]
    assert boilerplate.boilerplate_blocks(blocks, percent=14).count() == 0
    dropped = boilerplate.clean_pages(blocks, percent=11).where("dropped > 0").collect()
    assert {r.url.split("/")[2] for r in dropped} == {"large"} and len(dropped) == 4


def test_search(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Red fox, red"), (2, "blue FOX"), (3, "sea")], "id long, text string")
    postings = search.text_postings(docs, "id")
    assert {tuple(r) for r in postings.collect()} == {
        ("red", 1, 2), ("fox", 1, 1), ("blue", 2, 1), ("fox", 2, 1), ("sea", 3, 1)
    }
    path = str(tmp_path / "terms")
    search.write_postings(postings, path)
    top = search.term_search(spark.read.parquet(path), ["Red", "fox"], docs, "id", top=1).collect()
    assert [(r.id, r.matched, r.score) for r in top] == [(1, 2, 2.60269)]


def test_no_text_is_moved_to_clean_pages(spark, tmp_path, monkeypatch):
    rows = [response(i, f"https://h/{i}", f"<p>Share this</p><p>Story {i}</p>", HTML) for i in range(9)]
    path = str(tmp_path / "captured")
    responses(spark, *rows).write.parquet(path)
    captured = with_content(response_documents(spark.read.parquet(path)))
    blocks = boilerplate.page_blocks(captured)
    counts = boilerplate.key_counts(blocks)._jdf.queryExecution().executedPlan().toString()
    for line in re.findall(r"Exchange hashpartitioning\([^)]*\)", counts):
        assert "block_key" in line
    cleaned = boilerplate.clean_pages(blocks)
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert not re.search(r"Exchange (hash|range|round|single)", plan) and "BroadcastHashJoin" in plan
    expected = {i: (f"Story {i}", 1) for i in range(9)}
    assert {r.seq: (r.text, r.dropped) for r in cleaned.collect()} == expected
    # Beyond the bound of the broadcast the same comes of a join by host.
    monkeypatch.setattr(boilerplate, "BROADCAST_BYTES", 0)
    assert {r.seq: (r.text, r.dropped) for r in boilerplate.clean_pages(blocks).collect()} == expected


def test_block_counts_of_several_imports(spark, tmp_path):
    def blocks(numbers, *repeated):
        rows = [("h", [f"own {n}", *repeated]) for n in numbers] + [(None, ["lost"])]
        return spark.createDataFrame(rows, "host string, blocks array<string>")

    stored = boilerplate.HostBlocks(spark, str(tmp_path / "b"))
    assert stored.add(blocks(range(2), "menu"), 0).count() == 0
    for _ in range(2):
        # The batch is replayed: it counts once.
        found = stored.add(blocks(range(2, 4), "menu", "late"), 1).collect()
        assert [r.pages for r in found] == [4]
    found = stored.add(blocks(range(4, 40), "late"), 2).collect()
    assert [r.pages for r in found] == [38]
    stored.fold(1)
    assert [r.pages for r in stored.add(blocks([40], "late"), 3).collect()] == [39]
