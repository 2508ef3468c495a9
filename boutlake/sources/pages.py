"""Web pages into typed rows: functions from a page to its rows, called on batches of pages.

Python reads the markup alone; numbers, names, records, dates and events are made from its text by column
expressions, so they are tested and optimised like any others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i, date_range
from boutlake.sources.markup import feed, plain_links, rows_of

# Classes of a grid's rows, and names under which links carry ids, in the order they are tried.
ROW, OTHER_ROW = "dataGridRow", "dataGridAltRow"
ATHLETE_IDS = ("wrestlerId", "wrestlerID", "wrestlerid", "athleteId", "athleteID")
TEAM_IDS = ("teamId", "teamID", "teamid", "clubId", "clubID", "organizationId", "orgId")
# A surname's particle before the last word, and a suffix after the name.
PARTICLES = ("van", "von", "de", "da", "del", "der", "di", "du", "la", "le")
SUFFIX = r"(?i)(?:,?\s+(?:Jr\.?|Sr\.?|II|III|IV|V|VI))$"

#: Parts into which rows without a key of a join are dealt.
APART = 1024


class _Cell:
    """Text of an element, and target and text of the first link in it."""

    def __init__(self) -> None:
        self.text, self.href, self.label, self.in_link = "", None, "", False


class _Grid(HTMLParser):
    """Rows of tables: classes of each row, and the elements of one kind in it, within another kind if that is named."""

    def __init__(self, element: str, within: str | None) -> None:
        super().__init__()
        self.element, self.within = element, within
        self.rows: list[tuple[list[str], list[_Cell]]] = []
        self.open: list[_Cell] = []
        self.deep = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "tr":
            self.rows.append(((dict(attrs).get("class") or "").split(), []))
        if tag in ("tr", "td"):  # end tags may be missing
            self.open = []
        self.deep = 0 if tag == "tr" else self.deep + (tag == self.within)
        if tag == self.element and self.rows and (self.deep or self.within is None):
            self.open.append(_Cell())
            self.rows[-1][1].append(self.open[-1])
        elif tag == "a":
            for cell in self.open:
                if cell.href is None:
                    cell.href, cell.in_link = dict(attrs).get("href") or "", True

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            for cell in self.open:
                cell.in_link = False
        elif tag in ("tr", "td"):
            self.open, self.deep = [], 0
        elif tag == self.element and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        for cell in self.open:
            cell.text += data
            cell.label += data if cell.in_link else ""


def _rows(markup: str | None, element: str, within: str | None = None) -> list[tuple[list[str], list[_Cell]]]:
    parser = _Grid(element, within)
    feed(parser, markup)
    return parser.rows


class _Links(HTMLParser):
    """Attributes and text of every link."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[list] = []
        self.inside = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.found.append([dict(attrs), ""])
            self.inside = True

    def handle_endtag(self, tag: str) -> None:
        self.inside = self.inside and tag != "a"

    def handle_data(self, data: str) -> None:
        if self.inside:
            self.found[-1][1] += data


def _links(markup: str | None) -> Iterable[Sequence]:
    found = plain_links(markup)
    if found is None:
        parser = _Links()
        feed(parser, markup)
        found = parser.found
    return found


def row_source(kind: str) -> Callable:
    """Marks a function that gives rows with the columns of kind for one value; see lateral."""

    def mark(found: Callable) -> Callable:
        found.kind = kind
        return found

    return mark


@row_source("row_index int, texts array<string>, links array<string>")
def athlete_cells(html: str | None) -> Iterator[tuple]:
    """Texts and links of the divisions inside the cells of a list's rows."""
    n = 0
    for classes, cells in _rows(html, "div", "td"):
        if ROW in classes:
            n += 1
            yield n, [c.text.strip() for c in cells], [c.href for c in cells]


@row_source("row_index int, date_raw string, event_name string, event_js string")
def schedule_cells(html: str | None) -> Iterator[tuple]:
    """Date, event and link of a schedule's rows of three cells or more; rows with neither date nor event count but are left out."""
    n = 0
    for classes, cells in _rows(html, "td"):
        if len(cells) < 3 or not (ROW in classes or OTHER_ROW in classes):
            continue
        n += 1
        date, event = cells[1].text.strip(), (cells[2].label or cells[2].text).strip()
        if date or event:
            yield n, date, event, cells[2].href or ""


@row_source("link_index int, href string, text string, in_new_window boolean")
def page_links(html: str | None) -> Iterator[tuple]:
    """Every link of a page in order, with its text."""
    for i, (attributes, text) in enumerate(_links(html), 1):
        yield i, attributes.get("href") or "", " ".join(text.split()), attributes.get("target") == "_blank"


@row_source("indexes array<int>, texts array<string>, links array<string>")
def team_links(html: str | None) -> Iterator[tuple]:
    """Places, texts and targets of the links of a list of teams, those that open a window and carry a teamId, in one row a page."""
    opening = ((i, text, a.get("href") or "") for i, (a, text) in enumerate(_links(html), 1) if a.get("target") == "_blank")
    found = [(i, " ".join(text.split()), href) for i, text, href in opening if "teamId=" in href]
    if found:
        yield tuple(map(list, zip(*found, strict=True)))


def lateral(pages: DataFrame, rows: Callable, html: str = "html") -> DataFrame:
    """pages without html, once for each of the rows that a row_source gives for the page's html."""
    return rows_of(pages, html, rows, rows.kind)


def link_number(link: Column, names: tuple[str, ...]) -> Column:
    """The number that a link carries under the first of names it has, else under any of them whatever their case."""
    query = F.split_part(F.substring_index(F.substr(link, F.instr(link, "?")), "#", 1), F.lit("?"), F.lit(2))
    exact = [F.regexp_extract(query, rf"(?:^|&){n}=(\d+)(?:&|$)", 1) for n in names]
    loose = F.regexp_extract(link, rf"(?i)[?&](?:{'|'.join(names)})=(\d+)", 1)
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in (*exact, loose))).try_cast("long")


def page_name(raw: Column) -> tuple[Column, Column]:
    """First and last name of a list's name: without a trailing bracket, comma and suffix; "Last, First …" or "First … Last"."""
    clean = F.trim(F.regexp_replace(F.trim(raw), r"\s*\([^)]+\)\s*$", ""))
    clean = F.trim(F.regexp_replace(F.trim(F.regexp_replace(clean, r"\s+", " ")), r",\s*$", ""))
    clean = F.trim(F.regexp_replace(clean, SUFFIX, ""))
    parts = F.filter(F.transform(F.split(clean, ","), lambda x: F.trim(x)), lambda x: x != "")
    words = F.filter(F.split(clean, " "), lambda x: x != "")
    n = F.size(words)
    two = (n > 2) & F.lower(F.get(words, n - 2)).isin(*PARTICLES)
    last = F.when(clean.contains(","), F.get(parts, F.lit(0))).when(two, F.concat_ws(" ", F.get(words, n - 2), F.get(words, n - 1))).otherwise(F.get(words, n - 1))
    first = F.when(clean.contains(","), F.substring_index(F.get(parts, F.lit(1)), " ", 1)).when(n > 1, F.get(words, F.lit(0)))
    return F.nullif(first, F.lit("")), F.nullif(last, F.lit(""))


def page_record(raw: Column) -> dict[str, Column]:
    """Wins, losses, matches, win_pct (three places, 0 without matches) of the first "12-3" of a text, and the text."""
    p = r"(\d+)\s*-\s*(\d+)"
    wins, losses = (F.when(raw.rlike(p), F.regexp_extract(raw, p, i).try_cast("int")) for i in (1, 2))
    n = wins + losses
    return {"record_text": F.nullif(F.trim(raw), F.lit("")), "wins": wins, "losses": losses, "matches": n, "win_pct": F.when(n > 0, F.round(wins / n, 3)).when(n == 0, F.lit(0.0)).cast("decimal(5,3)")}


def athlete_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages (…, html) → a typed row for each athlete of each list page, with the pages' other columns."""
    rows = lateral(pages, athlete_cells, html)
    kept = [c for c in pages.columns if c != html]
    text, link = (lambda i: F.coalesce(F.get("texts", F.lit(i)), F.lit(""))), (lambda i: F.get("links", F.lit(i)))
    rows = rows.withColumn("name", F.trim(F.regexp_replace(text(2), r"[\s\x{A0}]+", " ")))
    first, last = page_name(F.col("name"))
    fields = {
        "wrestler_id": link_number(link(2), ATHLETE_IDS), "team_id": link_number(link(3), TEAM_IDS), "first_name": first, "last_name": last, "name": F.col("name"), "team": text(3),
        "weight_class": text(4), "gender": text(5), "grade": text(6), "level": text(7), **page_record(text(8)), "name_link": link(2), "team_link": link(3),
    }
    return rows.select(*kept, "row_index", *(c.alias(n) for n, c in fields.items()))


def schedule_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages (…, html) → row_index, date_raw, start_date, end_date, event_name, event_js of each schedule page's rows."""
    rows = lateral(pages, schedule_cells, html)
    start, end = date_range(F.regexp_replace("date_raw", r"\s+", " "))
    return rows.withColumns({"start_date": start, "end_date": end})


def event_teams(popups: DataFrame, html: str = "html") -> DataFrame:
    """popups (event_js, html) → event_js and its teams in order: the links that open a window and carry a teamId."""
    links = lateral(popups.select("event_js", F.col(html).alias("__html")), team_links, "__html")
    number = lambda link: F.regexp_extract(link, r"(?i)teamId=(\d+)", 1).try_cast("long")
    teams = F.transform(F.arrays_zip("indexes", "texts", "links"), lambda t: F.struct(t["indexes"].alias("link_index"), t["texts"].alias("team_name_raw"), number(t["links"]).alias("team_id")))
    # A popup's links, once for an event whatever the number of its rows.
    return links.groupBy("event_js").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(teams)))).alias("teams"))


def schedule_teams(events: DataFrame) -> DataFrame:
    """events (event_name, event_js, …) → a row for each team of a dual, one without team for any other event.

    A name with "@" is a dual of what stands before and after the first "@"; so is "A 16 B 0", with scores. The
    team before is away, the other at home. event_key is the link, else "A @ B", for duals, and the name for others.
    """
    name = F.trim(F.coalesce("event_name", F.lit("")))
    scored = r"^(.*?)(\d+)\s+(.+?)\s+(\d+)\s*$"
    part = lambda i: F.trim(F.regexp_extract(name, scored, i))
    side = lambda t, role, i, score: F.struct(F.trim(t).alias("team_name_raw"), F.lit(role).alias("team_role"), F.lit(i).cast("int").alias("team_index"), score.cast("long").alias("team_score"))
    none, at, has_scores = F.lit(None), name.contains("@"), name.rlike(scored)
    ends = [F.split_part(name, F.lit("@"), F.lit(i)) for i in (1, 2)]
    duals = F.array(side(ends[0], "away", 1, none), side(ends[1], "home", 2, none))
    scores = F.array(side(part(1), "away", 1, part(2).try_cast("long")), side(part(3), "home", 2, part(4).try_cast("long")))
    neither = F.array(F.struct(none.cast("string").alias("team_name_raw"), none.cast("string").alias("team_role"), none.cast("int").alias("team_index"), none.cast("long").alias("team_score")))
    is_dual = at | has_scores
    rows = events.withColumn("__t", F.explode(F.when(at, duals).when(has_scores, scores).otherwise(neither)))
    pair = F.when(at, F.concat(F.trim(ends[0]), F.lit(" @ "), F.trim(ends[1]))).when(has_scores, F.concat(part(1), F.lit(" @ "), part(3)))
    key = F.when(is_dual, F.coalesce(F.nullif(F.col("event_js"), F.lit("")), pair)).otherwise(F.nullif(name, F.lit("")))
    rows = rows.withColumns({"event_key": key, "event_team_count": F.when(is_dual, 2), "event_type": F.when(is_dual, "dual").otherwise("tournament")})
    return rows.select(*events.columns, "event_key", "__t.*", "event_team_count", "event_type")


def expand_teams(rows: DataFrame, teams: DataFrame, page: Sequence[str] = ()) -> DataFrame:
    """rows of schedule_teams, those whose link opens a list of teams replaced by a row for each team of it.

    teams: event_js, teams (array of team_name_raw, team_id) as event_teams gives them. Names with "@" stay, and so do
    events whose list is unknown or empty. Role and score stay; two teams make a dual. page: the columns that tell
    pages apart, by which rows that open no list are dealt to tasks; without them it is by all columns.
    """
    js = F.col("event_js")
    opens = ~F.col("event_name").contains("@") & js.startswith("javascript:") & js.contains("openEvent")
    known = teams.where(F.size("teams") > 0).select(F.col("event_js").alias("__js"), F.col("teams").alias("__teams"))
    # Rows that open no list meet none; by their own links, which most lack, all of them would go to one task.
    apart = F.pmod(F.xxhash64(*(page or [c for c, kind in rows.dtypes if "map<" not in kind])), F.lit(APART)).cast("string")
    both = rows.withColumn("__key", F.when(opens, js).otherwise(apart)).join(known, opens & (F.col("__key") == F.col("__js")), "left").drop("__key")
    both = both.select("*", F.posexplode_outer("__teams").alias("__i", "__t"))
    listed, n = F.col("__js").isNotNull(), F.size("__teams")
    return both.withColumns({
        "team_name_raw": F.when(listed, F.col("__t.team_name_raw")).otherwise(F.col("team_name_raw")), "team_id": F.when(listed, F.col("__t.team_id")),
        "team_index": F.when(listed, F.col("__i") + 1).otherwise(F.col("team_index")).cast("int"), "event_team_count": F.when(listed, n).otherwise(F.col("event_team_count")),
        "event_type": F.when(listed, F.when(n == 2, "dual").otherwise("tournament")).otherwise(F.col("event_type")),
    }).drop("__js", "__teams", "__i", "__t")


def classify_events(rows: DataFrame, page: list[str]) -> DataFrame:
    """rows whose number of teams is unknown, with that of the rows with a team of the same event on the same page; two make a dual.

    page: the columns that tell pages apart.
    """
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = rows.withColumn("__key", F.coalesce(blank("event_key"), blank("event_js"), blank("event_name"), F.lit("")))
    # A page's rows of one event; a join with counts would read all pages twice.
    both = rows.withColumn("__n", F.sum(b2i(F.col("team_index").isNotNull())).over(Window.partitionBy(*page, "__key")))
    unknown = F.col("event_team_count").isNull()
    return both.withColumns({
        "event_team_count": F.when(unknown & (F.col("__n") > 0), F.col("__n").cast("int")).otherwise(F.col("event_team_count")),
        "event_type": F.when(unknown, F.when(F.col("__n") == 2, "dual").otherwise("tournament")).otherwise(F.col("event_type")),
    }).select(*(c for c in rows.columns if c != "__key"))
