"""The page reader: facts from their places, tables on their grids."""

import random
from types import SimpleNamespace

import pyarrow as pa
import pytest

from dugout.sources import box_pages as B

MENU = "<nav><a href='/teams/NYY/2024'>x</a><a href='/teams/BOS/2024'>y</a><div class=score>9</div><strong>Venue</strong>: Menu</nav>"
BOX = "<div class='scorebox'><div><strong><a href='/teams/AAA/2024'>A</a></strong><div class='score'>{0}</div></div><div><a href='/teams/BBB/'>B</a><div class=\"big score\"> 4<br> </div></div>{1}</div>"
META = "<div class=scorebox_meta><div>Wednesday, October 30, 2024</div><div>Start Time: 8:08 p.m. Local</div><div><strong>Venue</strong>: Old <b>Park</b></div></div>"


def facts(html):
    return B.read_page(html)[0].known()


def test_only_the_first_score_box_counts():
    got = facts(MENU + BOX.format(3, META) + BOX.format(7, "").replace("AAA", "CCC"))
    assert (got["team"], got["score"], got["near box Venue"]) == ("AAA\nBBB", "3\n4", ": Old")
    assert got["meta"].split("\n") == ["Wednesday, October 30, 2024", "Start Time: 8:08 p.m. Local", "Venue: Old Park"]
    assert "team" not in facts(MENU) and "score" not in facts(MENU) and "near box Venue" not in facts(MENU)


def test_games_of_pages(spark):
    """Menus, quotes, nested and unclosed elements change nothing; what the box lacks is null; one pass reads it all."""
    odd = BOX.format("<i>5</i>", META).replace("</div></div>", "</div><img src=x><p>unclosed</div>", 1)
    cases = {
        "AAA202404010": (MENU + BOX.format(3, META), ("AAA", "BBB", 3, 4, "BBB", "Old", "2024-10-30", "8:08 PM", 9)),
        "BBB202404010": ("<p>after 13 innings</p>" + odd + MENU, ("AAA", "BBB", 5, 4, "AAA", "Old", "2024-10-30", "8:08 PM", 13)),
        "CCC202404010": (MENU + BOX.format("", "").replace("/teams/BBB/", "/x/"), (None, None, None, 4, None, None, None, None, 9)),
        "DDD202404010": (BOX.format(4, "") + "<table id=line_score><thead><tr><th>Team<th>1<th>11<th>R</thead><tr><td>A</table>", ("AAA", "BBB", 4, 4, None, None, None, None, 11)),
        "EEE202404010": (None, (None, None, None, None, None, None, None, None, 9)),
    }
    pages = spark.createDataFrame([(f"https://x.test/boxes/{i[:3]}/{i}.shtml", html) for i, (html, _) in cases.items()], "url string, html string")
    games = B.games(B.rows(pages))
    got = {r["game_id"]: r for r in games.collect()}
    names = ("away_team", "home_team", "runs_away_team", "runs_home_team", "winner", "venue", "game_date", "game_time", "innings_played")
    for i, (_, want) in cases.items():
        assert tuple(str(got[i][n]) if n == "game_date" and got[i][n] else got[i][n] for n in names) == want, i
    assert games._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_bios_of_pages(spark):
    html = "<h1><span>Ann <b>Lee</b></span></h1><strong>Bats:</strong> Left<div id='meta'><p><strong>Throws: </strong>Right</p><p><strong>MLB Debut:</strong> <a href=x>April 1, 2014</a> (x)</p><p>6-2, 200lb</p><p><strong>Born:</strong> <span>June 5, 1990</span></p></div>"
    with_data = html.replace("<span>June", "<span id='necro-birth' data-birth='1991-02-03'>June")
    pages = spark.createDataFrame([("https://x.test/players/l/leean01.shtml", html), ("https://x.test/players/l/leean02.shtml", with_data)], "url string, html string")
    got = {r["player_id"]: tuple(map(str, r))[1:] for r in B.bios(B.rows(pages)).collect()}
    same = ("Ann Lee", "L", "R")
    assert got == {"leean01": (*same, "1990-06-05", "2014-04-01", "74", "200"), "leean02": (*same, "1991-02-03", "2014-04-01", "74", "200")}


def brute_grid(rows):
    """Place by place over a large sheet: a cell takes the next free place of its row and all that it spans and are free."""
    held, out = {}, []
    for r, (group, _, cells) in enumerate(rows):
        last = max(i for i, (g, *_) in enumerate(rows) if g == group and all(rows[k][0] == group for k in range(min(i, r), max(i, r) + 1)))
        col = 0
        for k, cell in enumerate(cells):
            while (r, col) in held:
                col += 1
            start = col
            while col < start + cell.columns and (r, col) not in held:
                for down in range(r, min(last, r + (cell.rows or 999) - 1) + 1):
                    held[down, col] = (r, k)
                col += 1
        out.append({c: held[rr, c] for rr, c in held if rr == r})
    return [{c: held[rr, c] for rr, c in held if rr == r} for r in range(len(rows))]


@pytest.mark.parametrize("seed", range(60))
def test_grid_against_brute_force(seed):
    rng, group, rows = random.Random(seed), 0, []
    for _ in range(rng.randint(1, 9)):
        group += rng.random() < 0.2
        rows.append((group, False, [B.Cell(False, None, False, rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 1, 2, 3, 0])) for _ in range(rng.randint(0, 4))]))
    names = {id(c): (r, k) for r, (_, _, cells) in enumerate(rows) for k, c in enumerate(cells)}
    assert [{col: names[id(c)] for col, c in line.items()} for line in B.laid_out(rows)] == brute_grid(rows)


def table(html):
    return [r[6] for r in B._page_rows("u", html) if r[1] != B.FACTS]


def test_headings():
    cells = "<tr><td>a<td>1<td>2</tr>"
    want = [{"Name": "a", "AB": "1", "H": "2"}]
    assert table(f"<table><tr><th>Name<th>AB<th>H</tr>{cells}</table>") == want
    assert table(f"<table><thead><tr><th rowspan=2>Name<th colspan=2>Bat</tr><tr><th>AB<th>H</thead>{cells}</table>") == want
    assert table(f"<table><tr><th><th colspan=2>Bat</tr><tr><th>Name<th>AB<th>H</tr>{cells}</table>") == want
    assert table(f"<table><tr><td>Name<td>AB<td>H</tr>{cells}<tr><td>Name<td>AB<td>H</tr></table>") == want
    assert table(f"<table><thead><tr><th>Name<th>AB<th>H</thead><tr><th colspan=3>Top of the 1st</tr>{cells}</table>") == [{"Name": "Top of the 1st", "AB": "Top of the 1st", "H": "Top of the 1st"}, *want]
    assert table("<table><tr><td colspan=x rowspan=-1>A<td colspan=99999999>B</tr><tr><td>1</table>") == [{"A": "1"}]
    assert table("<table><tr><th>A</tr><tr><td>1<table id=i><tr><th>B</tr><tr><td>2</table></tr></table>") == [{"B": "2"}, {"A": "1"}]


def test_rows_are_handed_on_in_slices():
    """A batch of many pages is not held whole: its rows come out after each mebibyte of HTML."""
    html = "<table id='t'><tr><th>A</th></tr><tr><td>1</td></tr></table>" + "x" * 300_000
    batch = pa.RecordBatch.from_pydict({"url": [str(i) for i in range(10)], "html": [html] * 10})
    pages = SimpleNamespace(select=lambda *_: SimpleNamespace(mapInArrow=lambda f, _: f))
    for read in (B.rows(pages), B.cells(pages)):
        out = list(read(iter([batch])))
        assert [len(set(b.column("url").to_pylist())) for b in out] == [4, 4, 2]
