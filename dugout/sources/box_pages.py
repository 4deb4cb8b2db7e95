"""Pages as relations: cells of tables and facts of the page, one Python pass over each page's HTML.

The reader is a small helper inside mapInArrow: a stack of open elements tells where a text stands, so a fact is taken from
its own place (the score box, the line score, a label's element) and from no other part of the page. Tables are laid out
on a grid, so a cell that spans columns or rows stands under each of its headings. rows() gives the rows of tables under
their headings and the facts straight from that pass, as a page's cells are all there, so nothing is shuffled and no page is
read twice. A page that can't be read gives no cells; rows() gives one row that says why.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..functions import text as T

CELLS = "url string, table_id string, table_idx int, row_idx int, col_idx int, is_head boolean, text string, href string, stat string, is_indented boolean"

#: Elements without an end, and those whose text no reader sees.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset(("script", "style"))
#: Widest span that a cell may have.
WIDEST = 1000


@dataclass
class Cell:
    is_head: bool
    stat: str | None
    padded: bool
    columns: int = 1
    rows: int = 1  # 0: to the end of its group of rows
    text: str = ""
    href: str | None = None

    @property
    def is_indented(self) -> bool:
        return self.padded or self.text[:1] in (" ", "\u00a0", "\t") or "\u00a0" in self.text

    @property
    def clean(self) -> str:
        return self.text.replace("\u00a0", " ").strip()


@dataclass
class Table:
    name: str
    index: int
    rows: list[tuple[int, bool, list[Cell]]] = field(default_factory=list)  # number of the group, whether it is the head, cells
    group: int = 0
    in_head: bool = False
    is_line_score: bool = False


def laid_out(rows: list[tuple[int, bool, list[Cell]]]) -> list[dict[int, Cell]]:
    """Column to cell for each row of a table: spans fill all their places, and no place holds two cells."""
    out: list[dict[int, Cell]] = []
    waiting: dict[int, tuple[Cell, int]] = {}  # what reaches down from above, and for how many rows yet
    for i, (group, _, cells) in enumerate(rows):
        if i and group != rows[i - 1][0]:
            waiting = {}
        line = {col: cell for col, (cell, _) in waiting.items()}
        waiting = {col: (cell, left - 1) for col, (cell, left) in waiting.items() if left > 1}
        col = 0
        for cell in cells:
            while col in line:
                col += 1
            for place in range(col, col + cell.columns):
                if place in line:
                    break  # a cell from above stands here
                line[place], col = cell, place + 1
                if cell.rows != 1:
                    waiting[place] = (cell, cell.rows - 1 if cell.rows else len(rows))
        out.append(line)
    return out


def headings(table: Table, grid: list[dict[int, Cell]]) -> tuple[int, dict[int, str]]:
    """How many first rows are headings, and the name of each column: the lowest heading that says something.

    Headings are the rows of the table's head. Without one they are the first rows made of heading cells, down to the first
    one in which no cell spans columns; else the first row.
    """
    n = sum(in_head for _, in_head, _ in table.rows)
    if not n or not all(in_head for _, in_head, _ in table.rows[:n]):
        n = 1
        for i, (_, _, cells) in enumerate(table.rows):
            if not cells or not all(c.is_head for c in cells):
                break
            if all(c.columns == 1 for c in cells):
                n = i + 1
                break
    names: dict[int, str] = {}
    for line in grid[:n]:
        names |= {col: cell.clean for col, cell in line.items() if cell.clean or col not in names}
    return n, names


def _span(value: str | None, least: int, most: int) -> int:
    found = re.match(r"\s*(\d{1,6})", value or "")
    return min(most, max(least, int(found[1]))) if found else 1


#: Facts by the elements that hold them: each step is an element that stands somewhere inside the one before it.
PLACES = {
    "title": "title",
    "score": "div.scorebox div.score",
    "meta": "div.scorebox div.scorebox_meta div",
    "name": "h1 span",
    "about": "div#meta",
}


def _step(text: str) -> tuple[str, str, str]:
    """(tag, class, id) of a step."""
    tag, kind, name = re.fullmatch(r"(\w+)(?:\.([\w-]+))?(?:#([\w-]+))?", text).groups()
    return tag, kind or "", name or ""


#: Labels, in strong elements, whose text follows them.
LABELS = frozenset(("Venue", "Bats", "Bat", "Throws", "Throw", "Debut", "MLB Debut", "Born"))
#: By the tag of the element that holds the fact.
_PLACES: dict[str, list[tuple[str, list[tuple[str, str, str]]]]] = {}
for _fact_name, _path in PLACES.items():
    _steps = [_step(s) for s in _path.split()]
    _PLACES.setdefault(_steps[-1][0], []).append((_fact_name, _steps))


@dataclass
class Label:
    name: str
    depth: int  # of the element around it
    near: list[str] = field(default_factory=list)  # up to the next tag
    every: list[str] = field(default_factory=list)  # up to the next label, or the end of the element around it
    over: bool = False  # whether a tag came


class Page(HTMLParser):
    """Tables of a page, also those inside comments, and its facts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, frozenset[str], str]] = []
        self.tables: list[Table] = []
        self.done: list[Table] = []
        self.count: dict[str, int] = {}
        self.cell: Cell | None = None
        self.texts: list[tuple[str, int, list[str]]] = []  # facts that are being read: name, depth of the element, its text
        self.labels: list[Label] = []
        self.facts: dict[str, list[str]] = {}
        self.seen: list[str] = []
        self.boxes = 0

    # --- elements ------------------------------------------------------------------------------------------------

    def handle_comment(self, data: str) -> None:
        if "<table" in data:
            inner = Page()
            inner.count = self.count
            inner.feed(data)
            inner.finish()
            self.done += inner.done

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        kinds = frozenset(a.get("class", "").split())
        if "scorebox" in kinds:
            self.boxes += 1
            if self.boxes > 1:
                kinds -= {"scorebox"}  # the first one counts
        self._tag_came()
        if tag not in VOID:
            self.open.append((tag, kinds, a.get("id", "")))
            self.texts += [(fact, len(self.open), []) for fact, path in _PLACES.get(tag, ()) if self._stands(path)]
            if tag == "strong":
                self._end_labels(len(self.open) - 1)
                self.texts.append(("", len(self.open), []))
        if tag == "a" and self._boxed() and (team := re.search(r"/teams/([A-Z]{3})/", a.get("href", ""))):
            self.facts.setdefault("team", []).append(team[1])
        if tag == "span" and a.get("id") == "necro-birth" and a.get("data-birth"):
            self.facts.setdefault("born", []).append(a["data-birth"])
        self._table(tag, a)

    def _stands(self, path: list[tuple[str, str, str]]) -> bool:
        """Whether the innermost open element is the last step, with the others around it."""
        fits = lambda step, e: step[0] == e[0] and (not step[1] or step[1] in e[1]) and (not step[2] or step[2] == e[2])
        if not fits(path[-1], self.open[-1]):
            return False
        left = len(path) - 2
        for e in reversed(self.open[:-1]):
            if left < 0:
                break
            left -= fits(path[left], e)
        return left < 0

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        self._tag_came()
        if self.open and self.open[-1][0] == tag or any(t == tag for t, _, _ in self.open):
            while self.open.pop()[0] != tag:
                pass
            self._close()
        if tag in ("td", "th", "tr"):
            self.cell = None
        elif tag in ("thead", "tbody", "tfoot") and self.tables:
            self.tables[-1].in_head = False
            self.tables[-1].group += 1
        elif tag == "table" and self.tables:
            self.cell = None
            self.done.append(self.tables.pop())

    def _boxed(self) -> bool:
        return any("scorebox" in kinds for _, kinds, _ in self.open)

    def _tag_came(self) -> None:
        for label in self.labels:
            label.over = True

    def _close(self) -> None:
        """Ends the facts and labels of elements that are no longer open."""
        if not self.texts and not self.labels:
            return
        depth = len(self.open)
        for fact, at, text in self.texts:
            if at > depth and fact:
                self.facts.setdefault(fact, []).append("".join(text))
            elif at == depth + 1 and (name := "".join(text).strip().rstrip(": ")) in LABELS:
                self.labels.append(Label(f"box {name}" if self._boxed() else name, depth))
        self.texts = [x for x in self.texts if x[1] <= depth]
        self._end_labels(depth + 1)

    def _end_labels(self, depth: int) -> None:
        for label in self.labels:
            if label.depth >= depth:
                self.facts.setdefault(f"near {label.name}", []).append("".join(label.near))
                self.facts.setdefault(f"all {label.name}", []).append("".join(label.every))
        self.labels = [x for x in self.labels if x.depth < depth]

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in UNSEEN:
            return
        self.seen.append(data)
        if self.cell:
            self.cell.text += data
        for _, _, text in self.texts:
            text.append(data)
        for label in self.labels:
            label.every.append(data)
            if not label.over:
                label.near.append(data)

    # --- tables --------------------------------------------------------------------------------------------------

    def _table(self, tag: str, a: dict[str, str]) -> None:
        if tag == "table":
            name = a.get("id", "")
            suffix = next((s for s in ("batting", "pitching") if name.endswith(s)), name)
            self.tables.append(Table(name, self.count.get(suffix, 0), is_line_score=name == "line_score" or "linescore" in a.get("class", "").split()))
            self.count[suffix] = self.tables[-1].index + 1
            self.cell = None
        elif not self.tables:
            return
        elif tag in ("thead", "tbody", "tfoot"):
            self.tables[-1].in_head = tag == "thead"
            self.tables[-1].group += 1
        elif tag == "tr":
            self.cell = None
            self.tables[-1].rows.append((self.tables[-1].group, self.tables[-1].in_head, []))
        elif tag in ("td", "th"):
            table = self.tables[-1]
            if not table.rows:
                table.rows.append((table.group, table.in_head, []))
            padded = any(p in a.get("style", "").lower() for p in ("padding-left", "margin-left", "text-indent"))
            self.cell = Cell(tag == "th", a.get("data-stat") or None, padded, _span(a.get("colspan"), 1, WIDEST), _span(a.get("rowspan"), 0, 65534))
            table.rows[-1][2].append(self.cell)
        elif tag == "a" and self.cell and self.cell.href is None:
            self.cell.href = a.get("href") or None

    def finish(self) -> None:
        """Ends what is open at the end of the page."""
        self.close()
        self.open.clear()
        self._close()
        self._end_labels(0)
        self.done += reversed(self.tables)
        self.tables = []

    def known(self) -> dict[str, str]:
        """The facts as text; several of a kind by line."""
        for t in self.done:
            if t.is_line_score and "inning" not in self.facts:
                self.facts["inning"] = [c.clean for _, _, line in t.rows for c in line if c.is_head]
                self.facts["line_cells"] = [str(max((len(line) for _, _, line in t.rows if any(not c.is_head for c in line)), default=0))]
        said = max((int(n) for n in re.findall(r"(1[0-5])(?:th)? inning", "".join(self.seen).lower())), default=None)
        found = {k: "\n".join(" ".join(x.split()) for x in v) for k, v in sorted(self.facts.items())} | ({"said": str(said)} if said else {})
        return found if self.done or "about" in found else found | {"about": " ".join(" ".join(self.seen).split())}


def read_page(html: str | None) -> tuple[Page | None, str | None]:
    """The page, or why it can't be read."""
    page = Page()
    try:
        page.feed(html or "")
        page.finish()
    except AssertionError as error:  # the standard parser's answer to some broken declarations
        return None, f"parse error: {error}"
    return page, None


#: Signs of HTML after which a reader hands on its rows.
SLICE = 1 << 20


def _sliced(batches: Iterator[pa.RecordBatch], read: Callable[[str, str | None], list[tuple]], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """The rows that read(url, html) gives, in batches of about SLICE signs of HTML, so that Python holds few pages' rows at a time."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array([list(x.items()) if isinstance(x, dict) else x for x in c], t) for c, t in zip(cols, types, strict=True)], names=names)

    for batch in batches:
        rows, size = [], 0
        for url, html in zip(batch.column("url"), batch.column("html"), strict=True):
            text = html.as_py()
            rows += read(url.as_py(), text)
            size += len(text or "")
            if size >= SLICE:
                yield packed(rows)
                rows, size = [], 0
        if rows:
            yield packed(rows)


def cells(pages: DataFrame) -> DataFrame:
    """Cells of pages(url, html) on their tables' grids: a cell that spans places has a row for each.

    table_idx counts the tables of a kind (batting, pitching, or the same id) from 0.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CELLS.split(", ")]
        types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.bool_()]

        def one(url: str, html: str | None) -> list[tuple]:
            page, _ = read_page(html)
            return [(url, t.name, t.index, i, col, c.is_head, c.clean, c.href, c.stat, c.is_indented) for t in (page.done if page else ()) for i, line in enumerate(laid_out(t.rows)) for col, c in sorted(line.items())]

        return _sliced(batches, one, names, types)

    return pages.select("url", "html").mapInArrow(read, CELLS)


ROWS = "url string, table_id string, table_idx int, row_idx int, href string, is_indented boolean, cells map<string,string>, error string"
#: The table_id of the row that holds a page's facts.
FACTS = "#page"


def _page_rows(url: str, html: str | None) -> list[tuple]:
    began = time.perf_counter()
    page, fault = read_page(html)
    known = page.known() if page else {}
    out = [(url, FACTS, None, None, None, None, known | {"seconds": f"{time.perf_counter() - began:.6f}"}, None)]
    if not page or not any(t.rows for t in page.done):
        out.append((url, None, None, None, None, None, None, fault or ("missing page" if not html else "no table found")))
    for t in page.done if page else ():
        grid = laid_out(t.rows)
        n, names = headings(t, grid)
        for i, line in enumerate(grid[n:], n):
            named = [(names[col], cell.clean) for col, cell in line.items() if col in names]
            if named and not all(h == x for h, x in named):
                first = line.get(0)
                out.append((url, t.name, t.index, i, first and first.href, first and first.is_indented, dict(sorted(named)), None))
    return out


def rows(pages: DataFrame) -> DataFrame:
    """Rows of all tables of pages(url, html), cells by their columns' headings, and a row of each page's facts.

    Of equal headings the largest text counts. Headings repeated further down are not rows. A page without tables, or one
    that the parser gives up on, has one row with an error and nulls.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [c.rsplit(" ", 1) for c in ROWS.split(", ")]
        types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.map_(pa.string(), pa.string()), pa.string()]
        return _sliced(batches, _page_rows, [f for f, _ in fields], types)

    return pages.select("url", "html").mapInArrow(read, ROWS)


#: What measured() adds up while rows() are made.
METRICS = ("pages", "failed", "table_rows", "seconds", "slowest")


def measured(table_rows: DataFrame, watch: Observation) -> DataFrame:
    """rows(), which tell `watch` what they are when they are first made: no second pass counts them."""
    is_page = F.col("table_id") == FACTS
    seconds = F.when(is_page, F.try_element_at("cells", F.lit("seconds")).try_cast("double"))
    values = (F.count_if(is_page), F.count_if(F.col("error").isNotNull()), F.count_if(F.col("table_id").isNotNull() & ~is_page), F.coalesce(F.sum(seconds), F.lit(0.0)), F.coalesce(F.max(seconds), F.lit(0.0)))
    return table_rows.observe(watch, *(v.alias(n) for n, v in zip(METRICS, values, strict=True)))


def wide(table_rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(url, table_id, table_idx, row_idx, href, is_indented, *columns) of rows(); columns: heading to name."""
    return table_rows.select("url", "table_id", "table_idx", "row_idx", "href", "is_indented", *(F.try_element_at("cells", F.lit(h)).alias(n) for h, n in columns.items()))


def page_errors(table_rows: DataFrame) -> DataFrame:
    """(game_id, url, error) of the pages that lack what a game needs: tables at all, a box score, or plays."""
    has = lambda test: F.coalesce(F.bool_or(test), F.lit(False))
    seen = table_rows.groupBy("url").agg(
        F.first("error", ignorenulls=True).alias("error"), has(F.col("table_id").endswith("batting")).alias("batting"), has(F.col("table_id").endswith("pitching")).alias("pitching"), has(F.col("table_id") == "play_by_play").alias("plays")
    )
    lacks = F.concat_ws(", ", *(F.when(~F.col(c), F.lit(f"no {c} table found")) for c in ("batting", "pitching", "plays")))
    return seen.select(T.game_id("url").alias("game_id"), "url", F.coalesce("error", F.nullif(lacks, F.lit(""))).alias("error")).where("error is not null")


def _team():
    return F.when(F.col("table_idx") == 0, "away").otherwise("home")


def batting(cell_rows: DataFrame) -> DataFrame:
    stats = {"Batting": "entry", "AB": "AB", "R": "R", "H": "H", "RBI": "RBI", "BB": "BB", "SO": "SO", "PA": "PA", "Details": "details"}
    rows = wide(cell_rows.where(F.col("table_id").endswith("batting")), stats).where(F.col("entry").isNotNull() & ~F.col("entry").contains("Team Totals"))
    named = rows.withColumn("p", T.player_and_positions(F.col("entry")))
    counted = {s: T.safe_int(F.col(s)) for s in ("AB", "R", "H", "RBI", "BB", "SO", "PA")}
    details = {n: T.detail_count(F.col("details"), s) for s, n in (("HR", "HR"), ("2B", "doubles"), ("3B", "triples"), ("SB", "SB"), ("CS", "CS"), ("HBP", "HBP"), ("GDP", "GDP"), ("SF", "SF"), ("SH", "SH"))}
    return named.select(T.game_id("url").alias("game_id"), _team().alias("team"), "row_idx", T.player_id("href").alias("player_id"), "p.player_name", "p.positions", F.coalesce("is_indented", F.lit(False)).alias("is_indented"), *(c.alias(s) for s, c in counted.items()), *(F.coalesce(c, F.lit(0)).alias(s) for s, c in details.items()))


def pitching(cell_rows: DataFrame, *carried: str) -> DataFrame:
    """Pitchers of rows(); `carried`: columns of rows() that come along, as url, where several pages may name one game."""
    stats = {"Pitching": "entry", "IP": "IP", "H": "H", "R": "R", "ER": "ER", "BB": "BB", "SO": "SO", "HR": "HR", "BF": "BF", "Pit": "PC"}
    rows = wide(cell_rows.where(F.col("table_id").endswith("pitching")), stats).where(F.col("entry").isNotNull() & ~F.col("entry").contains("Team Totals") & (F.col("entry") != ""))
    counted = (T.safe_int(F.col(s)).alias(s) for s in ("H", "R", "ER", "BB", "SO", "HR", "BF", "PC"))
    return rows.select(*carried, T.game_id("url").alias("game_id"), _team().alias("team"), "row_idx", T.player_id("href").alias("player_id"), T.normal_name(T.without_decisions("entry")).alias("player_name"), T.decisions("entry").alias("decisions"), F.col("IP").try_cast("decimal(4,1)").alias("IP"), *counted)


def plays(cell_rows: DataFrame) -> DataFrame:
    columns = {"Inn": "inn", "Batter": "batter", "Pitcher": "pitcher", "Pit(cnt)": "pit_cnt", "Play Description": "description"}
    return wide(cell_rows.where(F.col("table_id") == "play_by_play"), columns).select(T.game_id("url").alias("game_id"), F.col("row_idx").cast("long").alias("seq"), *columns.values())


def _facts(table_rows: DataFrame, url_column: Column) -> DataFrame:
    return table_rows.where(F.col("table_id") == FACTS).select(url_column, "cells")


def _fact(name: str) -> Column:
    return F.try_element_at("cells", F.lit(name))


def _lines(name: str) -> Column:
    """All texts of a fact, in page order."""
    return F.split(F.coalesce(_fact(name), F.lit("")), "\n")


def games(table_rows: DataFrame) -> DataFrame:
    """Facts of games, out of rows(): teams, scores, place and time from the score box, innings from the line score."""
    team, score = (lambda i, n=n: F.when(F.size(_lines(n)) >= 2, F.get(_lines(n), F.lit(i))) for n in ("team", "score"))
    title, starts = F.coalesce(_fact("title"), F.lit("")), F.filter(_lines("meta"), lambda x: x.contains("Start Time:"))
    day = F.array_compact(F.transform(_lines("meta"), M.long_date))
    heads, line_cells = _lines("inning"), F.coalesce(_fact("line_cells").try_cast("int"), F.lit(0))
    said = F.concat(F.coalesce(_fact("said"), F.lit("")), F.lit(" inning"))
    base = _facts(table_rows, T.game_id("url").alias("game_id")).select(
        "game_id", F.get(day, F.lit(0)).alias("game_date"), M.start_time(F.get(starts, F.lit(0))).alias("game_time"), team(0).alias("away_team"), team(1).alias("home_team"),
        score(0).try_cast("int").alias("runs_away_team"), score(1).try_cast("int").alias("runs_home_team"), M.venue(F.get(_lines("near box Venue"), F.lit(0))).alias("venue"),
        M.is_playoff(title).alias("is_playoff"), M.playoff_round(title).alias("playoff_round"), M.innings_played(heads, line_cells, said).alias("innings_played"),
    )
    sides = (F.col("home_team"), F.col("away_team"), F.col("runs_home_team"), F.col("runs_away_team"))
    return base.withColumns({"season": F.year("game_date"), "winner": M.winner(*sides), "loser": M.loser(*sides)})


def bios(table_rows: DataFrame) -> DataFrame:
    """Facts of player pages, out of rows(): texts of their labels, also of labels without an element of their own."""
    first = lambda name: F.nullif(F.trim(F.get(_lines(name), F.lit(0))), F.lit(""))
    about = F.coalesce(_fact("about"), F.lit(""))
    said = lambda name: F.nullif(F.regexp_extract(about, rf"{name}:\s*(.{{0,60}})", 1), F.lit(""))
    label = lambda *names: F.coalesce(*(first(f"near {n}") for n in names), F.regexp_extract(said(names[0]), r"^(\w+)", 1))
    day = lambda *names: F.coalesce(*(M.long_date(first(f"all {n}")) for n in names), M.long_date(said(names[0])))
    return _facts(table_rows, T.player_id("url").alias("player_id")).select(
        "player_id", first("name").alias("full_name"), M.hand(label("Bats", "Bat")).alias("bats"), M.hand(label("Throws", "Throw")).alias("throws"), F.coalesce(first("born").try_cast("date"), day("Born")).alias("birth_date"),
        day("Debut", "MLB Debut").alias("debut_date"), M.height_inches(about).alias("height_inches"), M.weight_pounds(about).alias("weight_lbs"),
    )
