"""Pages, logs, strings, text jobs, intervals and access rules on hand-made inputs."""

import base64
import uuid
from collections import Counter

from pyspark.sql import functions as F

from lakejobs.functions import html, logs, semi, strings, texts, tournaments, vectors
from lakejobs.operators import access
from lakejobs.operators.families import spread_families
from lakejobs.operators.intervals import peak_overlap, range_join


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


PAGE = """<html><head><title>Notes</title><style>p{}</style></head><body>
<div class="section"><h2>First</h2><p>a</p><p>b</p></div>
<div class="section wide"><h2>New join</h2><p>intro</p><p>Faster joins. See <a href="/docs/j">docs</a> and <a href="#x">x</a>
<ul class="simple"><li>one<li>two</ul></div>
<div class="section"><h2>Lonely</h2><p>only one</p></div>
<!-- <table><thead><tr><th>Wk</th><th>Day</th><th>Date</th><th>Time</th><th>Home</th><th>Score</th><th>Away</th><th>Att</th><th>Venue</th><th>Referee</th></tr></thead>
<tbody><tr><th rowspan="2">3</th><td rowspan="2">Sat</td><td rowspan="2">2023-08-12</td><td>20:30 (21:30)</td><td>AA</td><td>1-1</td><td>BB</td><td>47,845</td><td>V</td><td>R</td></tr>
<tr><td>18:00</td><td>CC</td><td></td><td>DD</td><td></td><td>W</td><td>S</td></tr>
<tr><td></td><td></td><td></td><td></td><td></td><td></td><td></td><td></td><td></td><td></td></tr></tbody></table> -->
</body></html>"""


def test_page_rules(spark):
    pages = spark.createDataFrame([(1, "http://h.org/2023-2024/a", PAGE)], "page_id long, url string, html string")
    found = html.sections(pages, "page_id").collect()
    assert [(r["title"], r["info"], r["links"]) for r in found] == [("New join", "Faster joins. one two", ["http://h.org/docs/j"])]
    outline = html.outlines(pages, "page_id").first()
    assert outline["title"] == "Notes" and outline["links"] == ["http://h.org/docs/j"] and outline["items"] == ["one", "two"]
    games = html.schedules(pages, "page_id").orderBy("line").collect()
    assert [(r["wk"], r["date"], r["time"], r["home"], r["home_goals"], r["away_goals"], r["away"], r["attendance"]) for r in games] == [
        (3, "2023-08-12", "20:30", "AA", 1, 1, "BB", 47845), (3, "2023-08-12", "18:00", "CC", None, None, "DD", None)]
    assert pages.select(html.season_of("url")).first()[0] == "2023-2024"


def test_page_facts_keep_references_that_are_cut_off(spark, tmp_path):
    import __spark_entry__ as entry_module
    import duckdb

    from tests.oracle import compare

    titles = ["a&amp;&amp", "b &eacute; &#233; &copy", "c&lt;&amp;lt;&#39;&quot", "d & e &;"]
    made = [(i, "http://h.org/", f'<title>{x}</title><ul><li>&amp<li>y</ul><a href="/p?a=1&amp">') for i, x in enumerate(titles)]
    spark.createDataFrame(made, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    found = entry_module.queries()["html_page_facts"](spark, str(tmp_path))
    assert compare(found, con, entry_module.oracle_sql()["html_page_facts"]) == (4, None)


def test_pages_reach_the_parser_a_hundred_at_a_time(spark):
    pages = spark.range(3).selectExpr("id AS page_id", "'http://h.org/' AS url", "'<title>x</title>' AS html")
    for found in (html.outlines(pages, "page_id"), html.sections(pages, "page_id"), html.schedules(pages, "page_id")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "MapInPandas" not in plan


def test_schedule_lines_are_made_in_the_page_without_a_shuffle(spark):
    page = "<table><tr><th>Wk</th><th>Date</th><th>Home</th><th>Score</th><th>Att</th><th>Attendance</th></tr>"
    page = page.replace("<tr>", "<thead><tr>") + "</thead><tbody><tr><td>1</td><td>d</td><td>A</td><td>2-1</td><td>5</td><td>4</td></tr></tbody></table>"
    found = html.schedules(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), "page_id")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["wk"], r["home"], r["home_goals"], r["attendance"]) for r in found.collect()] == [(1, "A", 2, 5)]


def test_summaries_shuffle_nothing(spark):
    made = [(1, "Aa bb. Bb cc aa!\n\nDd ee ff gg"), (2, None), (3, ""), (4, "\n One two. ")]
    found = texts.summarize(spark.createDataFrame(made, "id int, text string"), "id", "text", 5)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == [(1, "Aa bb. Bb cc aa!"), (2, ""), (3, ""), (4, " One two.")]


def test_plain_pages_are_read_as_the_parser_reads_them():
    import random

    rng = random.Random(7)
    bits = ["<p>", "</p>", '<td rowspan="2" id="x y">', "</td>", "<tr>", "</tr>", "<br>", "a", "b > c", "\n", '"', "<li>", "<ul>", "</ul>",
            '<div class="section">', "</div>", '<a href="/x">', "</a>", "\r\n", "<!-- c -->", "<P>", "&amp", "<title>", "<br/>", "</p >", "<"]
    plain = 0
    for _ in range(3000):
        page = "".join(rng.choice(bits[:-7] if rng.random() < 0.97 else bits) for _ in range(rng.randint(0, 14)))
        found = html._parse_plain(page)
        reader = html.Elements()
        reader.feed(page)
        reader.close()
        if found is not None:
            plain += 1
            assert [{**e, "text": "".join(e["text"])} for e in found] == [{**e, "text": "".join(e["text"])} for e in reader.found]
    assert plain > 1500
    assert all(html._parse_plain(p) is None for p in ("<script><p></script>", "a&amp;b", "<!-- x -->", "<p", "</p class=\"x\">"))


def test_log_parse(spark):
    key = uuid.UUID("12345678-1234-5678-1234-567812345678")
    token = base64.b64encode(key.bytes).decode().rstrip("=").replace("+", "@").replace("/", "-")
    line = (
        f'own buck [06/Feb/2024:00:00:38 -0500] 10.0.0.1 arn:r={token},s req OP key "GET /a/b HTTP/1.1" 200 - 512 600 7 8 '
        '"-" "agent x" - host sig suite auth head tls')
    found = logs.parse_log(spark.createDataFrame([(line,), ("noise",), (line.replace(" 512 ", " - "),)], "value string"))
    first, noise, dash = found.collect()
    assert (first["bytes_sent"], first["request_uri"], str(first["request_date"]), first["recipient_id"]) == (512, "/a/b", "2024-02-06", str(key))
    assert noise["bucket"] is None and noise["recipient_id"] is None and dash["bytes_sent"] is None
    assert logs.egress_rows(found).count() == 1


def test_strings(spark):
    one = spark.createDataFrame([("123-45-6789", "jane@x.org", "Copa America")], "ssn string, email string, t string")
    got = one.select(
        strings.mask_id("ssn"), strings.mask_email("email"), strings.keyword_class("t", [(("cup",), 1), (("copa",), 2)], 0),
        strings.lookup("t", {"Copa America": "CA"}), strings.part("t", " ", 5)).first()
    assert tuple(got) == ("***-**-6789", "jan***@x.org", 2, "CA", None)


def test_tournaments_by_name(spark):
    df = spark.createDataFrame([("FIFA World Cup",), ("Friendly",), ("Gold Cup",), (None,)], "n string").coalesce(1)
    picks = lambda *known: [f("n", *known) for f in (tournaments.tournament_type, tournaments.tournament_weight, tournaments.k_factor)]
    other = ("Other", 0.5, 30.0)
    assert [tuple(r) for r in df.select(*picks()).collect()] == [("World Cup", 1.0, 60.0), ("Friendly", 0.4, 20.0), other, other]
    own = {"Gold Cup": tournaments.Tournament("Continental Final", 0.85, 50.0)}
    assert [tuple(r) for r in df.select(*picks(own)).collect()] == [other, other, ("Continental Final", 0.85, 50.0), other]


def test_shred_keeps_unknown_types(spark):
    v = spark.sql("""SELECT parse_json('{"user": {"id": 7}, "n": "x"}') AS v""")
    got = semi.shred(v, "v", {"id": ("$.user.id", "int"), "n": ("$.n", "int")}).first()
    assert got["id"] == 7 and got["n"] is None


def test_text_rules(spark):
    docs = spark.createDataFrame(
        [(1, "I love this good thing. It is bad"), (2, "my laptop is broken"), (3, "")], "id long, text string")
    assert [r[0] for r in docs.orderBy("id").select(texts.sentiment("text")).collect()] == ["positive", "negative", "neutral"]
    labels = {"bad": ("broken",), "fine": ("good",)}
    assert [r[0] for r in docs.orderBy("id").select(texts.classify("text", labels)).collect()] == ["fine", "bad", "bad"]
    mail = spark.createDataFrame([("mail a.b@c.org or call +33 6 12 34 56 78, pay 100",)], "text string")
    assert tuple(mail.select(texts.extract("text", ["email", "phone", "url"]).alias("e")).first()["e"]) == ("a.b@c.org", "+33 6 12 34 56 78", None)
    assert mail.select(texts.mask_entities("text", ["email", "phone"])).first()[0] == "mail [MASKED] or call [MASKED], pay 100"
    answers = texts.infer(docs, "text", "n", lambda batch: [str(len(p)) for p in batch], 2)
    assert {r["id"]: r["n"] for r in answers.collect()} == {1: "33", 2: "19", 3: "0"}
    assert docs.columns == ["id", "text"]


def test_summary_equals_a_loop(tables):
    import re

    docs = tables.documents.where("n_chars < 4000")
    got = {r["doc_id"]: r["summary"] for r in texts.summarize(docs, "doc_id", "text", 40).collect()}
    for r in docs.collect():
        parts = [(i, s, s.lower().split()) for i, s in enumerate(re.split(r"(?<=[.!?])\s+|\n+", r["text"])) if s.split()]
        counts = Counter(w for _, _, ws in parts for w in ws)
        scored = sorted(((-sum(counts[w] for w in ws) / len(ws), i, len(ws)) for i, _, ws in parts))
        used, kept = 0, []
        for _, i, n in scored:
            used += n
            if used <= 40:
                kept.append(i)
        assert got[r["doc_id"]] == " ".join(s for i, s, _ in parts if i in kept)


def test_vector_top_k(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "id long, v array<float>")
    assert [r["id"] for r in vectors.top_k(df, "v", [1.0, 0.1], 2, "id").collect()] == [1, 3]


def test_intervals_against_nested_loops(tables, spark):
    spans = tables.run_timeline.select(
        (F.col("job_id") % 3).alias("k"), F.unix_timestamp(F.col("period_start_time").cast("timestamp")).alias("lo"), "slice_sec"
    ).withColumn("hi", F.col("lo") + F.col("slice_sec") * 20).drop("slice_sec")
    data = spans.collect()
    peaks = peak_overlap(spans.withColumn("one", F.lit(1)), ["k"], "lo", "hi", {"peak": "one"}, 300)
    count = Counter()
    for k, lo, hi in data:
        for second in range(lo, hi + 1):
            count[k, second] += 1
    best = {}
    for (k, second), n in count.items():
        best[k, second // 300] = max(best.get((k, second // 300), 0), n)
    assert {(r["k"], r["bucket"]): r["peak"] for r in peaks.collect()} == best
    points = spark.range(1_704_067_200 // 3600, 1_704_067_200 // 3600 + 240).select((F.col("id") * 3600).alias("at"))
    pairs = range_join(points, spans, "at", "lo", "hi", 1000).count()
    assert pairs == sum(1 for i in range(240) for _, lo, hi in data if lo <= 1_704_067_200 + 3600 * i <= hi)


def test_families(spark):
    five = spark.createDataFrame([("A", "a1"), ("A", "a2"), ("B", "b1"), ("B", "b2"), ("B", "b3")], "f string, c string")
    picked = spread_families(five, "f", "c").collect()
    groups = {}
    for r in picked:
        groups.setdefault(r["group_id"], {})[r["family"]] = r["child"]
    assert len(groups) == 6 and len({tuple(sorted(g.items())) for g in groups.values()}) == 6
    assert groups[0] == {"A": "a1", "B": "b1"} and groups[5] == {"A": "a2", "B": "b3"}


def test_access(spark):
    people = spark.createDataFrame([(1, "US", "a@x.org"), (2, "EU", "b@x.org")], "id long, region string, email string")
    grants = spark.createDataFrame([("ann", "US")], "principal string, value string")
    assert [r["id"] for r in access.apply_row_filter(people, "region", grants, "ann").collect()] == [1]
    assert access.apply_row_filter(people, "region", grants, "root", {"root"}).count() == 2
    assert access.apply_row_filter(people, "region", grants, "bob").count() == 0
    masks = {"email": ("pii", F.lit("hidden"))}
    assert access.apply_masks(people, masks, {"pii"}).first()["email"] == "a@x.org"
    assert access.apply_masks(people, masks, set()).first()["email"] == "hidden"
