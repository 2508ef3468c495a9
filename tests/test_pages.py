"""Markup on the plain path and through HTMLParser, and rows of pages in bounded batches."""

import random
import tracemalloc
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F

from boutlake.sources import markup, pages, readers

PIECES = ["<tr>", "</tr>", "<TD class='x y'>", "</td >", '<a href="/p?a=1&amp;wrestlerId=5">', "<a href='/t?x=1&teamId=3&copy=2&notit;' target=\"_blank\">", "</a>", " text ", "&nbsp;", "&amp", "&#65", "&", "&lt;b&gt;"]
PIECES += ["<br/>", "<div  id=3 hidden>", "x > y", "\n", "é ", "<td colspan=4>", "<td a=\"\" A='q&quot;'>", "&copyx", "<hr a=b/>"]
ODD = ["<!-- c -->", "<", "<script>a<b</script>", "<x-y>", "<td a=1 b", "< td>", "<td a='<'>", "</>", "<td a = 'b'>", "<title>&amp;</title>", '<p a="x"b=c>']


class Events(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found.append((tag, attrs))

    def handle_endtag(self, tag):
        self.found.append((tag,))

    def handle_data(self, data):
        joined = bool(self.found) and isinstance(self.found[-1], str)
        self.found[-1:] = [self.found[-1] + data] if joined else [*self.found[-1:], data]


def test_plain_markup_gives_the_events_of_a_parser():
    r, plain = random.Random(3), 0
    for n in range(4000):
        text = "".join(r.choice(ODD if n % 2 and r.random() < 0.1 else PIECES) for _ in range(r.randrange(12)))
        one, two = Events(), Events()
        one.feed(text)
        one.close()
        markup.feed(two, text)
        plain += markup._PLAIN.fullmatch(text) is not None
        assert one.found == two.found, text
    assert plain > 1000


def test_rows_leave_a_task_in_small_batches(spark, monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(["x", "y"])], ["k", "html"])
    schema = pa.schema([("k", pa.int64()), ("n", pa.int32())])
    monkeypatch.setattr(markup, "ROWS_AT_ONCE", 3)
    made = list(markup._made(batch, [0, 0, 1, 1, 1, 1, 1], [(i,) for i in range(7)], schema))
    assert [b.num_rows for b in made] == [3, 3, 1] and [x for b in made for x in b["k"].to_pylist()] == [7, 7, 8, 8, 8, 8, 8]
    html = "<table>" + "<tr><td>a</td><td><a href='/p?i=1'>b</a></td></tr>" * 9000 + "</table>"
    rows = readers.grid_rows(spark.createDataFrame([(1, html), (2, None), (3, "<tr><td>z")], "page_id int, html string")).collect()
    assert [r.row_index for r in rows if r.page_id == 1] == list(range(1, 9001)) and len(rows) == 9000
    links = pages.lateral(spark.createDataFrame([(None, "u", "<a href='x'>1</a>"), (2, None, None)], "page_id int, u string, html string"), pages.page_links)
    assert list(map(tuple, links.collect())) == [(None, "u", 1, "x", "1", False)]


def test_numbers_of_links():
    links = ["/p?id=5", "http://x.y/p?a=1&amp;id=6", "/p?i%64=7", "/p?id=+8", "/p?id=&id=9#id=10"]
    assert [readers.link_id([x], "id", 5) for x in links] == [None, 6, 7, None, 9] and readers.link_id(links, "id") == 5


def test_schedules_and_lists_of_teams_are_read_in_batches(spark):
    one = spark.createDataFrame([("j", "<a target='_blank' href='/t?teamId=4'>T</a>")], "event_js string, html string")
    for df in (pages.schedule_rows(one), pages.event_teams(one)):
        assert "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString()
    assert pages.event_teams(one).first().teams[0].team_id == 4


def test_links_of_plain_markup_are_those_of_a_parser(monkeypatch):
    r, pieces = random.Random(4), [*PIECES, "<a href=x />", "<A HREF='1' href=\"2\">", "</A >", "<b>", "</b>", "<abbr>", "&am", "p;", "<a>", "<a target=_blank href='?teamId=7'>"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(14))) for _ in range(4000)]
    found = [(list(pages.page_links(x)), list(pages.team_links(x))) for x in texts]
    assert sum(markup.plain_links(x) is not None for x in texts) > 1000 and sum(len(t) for _, t in found) > 100
    monkeypatch.setattr(pages, "plain_links", lambda _: None)
    assert found == [(list(pages.page_links(x)), list(pages.team_links(x))) for x in texts]


def test_a_list_of_teams_leaves_python_as_one_row():
    html = "<a target='_blank' href='/t?teamId=4'> T  U</a><a href='/t?teamId=5'>x</a><a target='_blank' href='/t?teamId=6'>V</a>"
    assert list(pages.team_links(html)) == [([1, 3], ["T U", "V"], ["/t?teamId=4", "/t?teamId=6"])] and list(pages.team_links("<a>")) == []


def test_events_that_open_no_list_are_spread_over_tasks(spark):
    for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        events = spark.createDataFrame([(i, f"A{i} @ B", None if i % 3 else "") for i in range(400)] + [(400, "Open", "javascript:openEvent(1)")], "id int, event_name string, event_js string")
        lists = pages.event_teams(spark.createDataFrame([("javascript:openEvent(1)", "<a target='_blank' href='/t?teamId=4'>T</a>")], "event_js string, html string"))
        rows = pages.expand_teams(pages.schedule_teams(events), lists).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert len(rows) == 801 and [r.team_id for r in rows if r.id == 400] == [4]
    assert len({r.task for r in rows if r.id < 400}) == 4


def test_rows_of_a_long_page_are_not_held_together():
    html = "<table>" + "<tr><td> a <tr></td><td><a href='/p?i=1'>b</a></tr><td>c</td>" * 20000 + "</table>"
    whole = readers._Rows()
    markup.feed(whole, html)
    tracemalloc.start()
    n = sum(1 for _ in readers.html_rows(html))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n == len([r for r in whole.rows if r[0] or r[1]]) == 20000 and peak < 1_000_000
    assert list(readers.html_rows(html)) == [r for r in whole.rows if r[0] or r[1]]
