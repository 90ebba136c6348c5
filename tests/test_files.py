"""Readers of release files."""

import zipfile

import pytest

from vintora.sources import files


def test_flat_file(spark, tmp_path):
    (tmp_path / "f.txt").write_text("series_id   \tyear\tvalue  \n 0001  \t2024\t  1.5 \n 0002 \t2024\t - \n")
    rows = files.flat_file(spark, str(tmp_path / "f.txt"), "series_id string, year int, value double").collect()
    assert [tuple(r) for r in rows] == [("0001", 2024, 1.5), ("0002", 2024, None)]


def test_fetch_log(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"request_id":"1","url":"u","requested_at":"2024-01-01T00:00:00Z","response_headers":{"etag":"x"}}\n\n')
    row = files.fetch_log(spark, str(tmp_path)).where("url IS NOT NULL").first()
    assert row.request_id == "1" and row.response_headers == {"etag": "x"}


def test_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("m.csv", 'area,name,n\n01,"x, y",3\n02,z,\n')
    rows = files.zipped_csv(spark, str(tmp_path / "a.zip"), "area string, name string, n int").orderBy("area").collect()
    assert [tuple(r) for r in rows] == [("01", "x, y", 3), ("02", "z", None)]
    with pytest.raises(ValueError):
        files.zipped_csv(spark, str(tmp_path / "a.zip"), "other string")


def test_calendar_and_feed(spark, tmp_path):
    (tmp_path / "c.ics").write_text("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:7\r\nDTSTART;TZID=America/New_York:20260306T083000\r\nSUMMARY:Employment\r\n  Situation\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n", newline="")
    row = files.calendar(spark, str(tmp_path / "c.ics")).first()
    assert (row.uid, row.title, str(row.starts), row.zone) == ("7", "Employment Situation", "2026-03-06 08:30:00", "America/New_York")
    event = lambda uid, start: f"BEGIN:VEVENT\nUID:{uid}\nDTSTART{start}\nSUMMARY:x\nEND:VEVENT\n"
    (tmp_path / "d.ics").write_text(event("a", ";VALUE=DATE:20260306") + event("b", ":20260306T133000Z") + event("c", ":20260306T083000") + event("d", ":never"))
    got = {r.uid: (str(r.starts), r.zone, r.all_day) for r in files.calendar(spark, str(tmp_path / "d.ics")).collect()}
    assert got == {"a": ("2026-03-06 00:00:00", None, True), "b": ("2026-03-06 13:30:00", "UTC", False), "c": ("2026-03-06 08:30:00", None, False), "d": ("None", None, False)}
    (tmp_path / "f.rss").write_text('<feed><entry><title>A</title><link href="/x"/><updated>2026</updated></entry></feed>')
    (tmp_path / "g.rss").write_text("<rss><item><title>B</title><link>/y</link><pubDate>2025</pubDate></item></rss>")
    assert sorted(map(tuple, files.feed(spark, str(tmp_path / "*.rss")).collect())) == [("A", "/x", "2026"), ("B", "/y", "2025")]


def test_errata_page(spark, tmp_path):
    (tmp_path / "e.html").write_text("<table><tr><th>h</th></tr><tr><td>1</td><td>P</td><td>Database</td><td><a>T</a></td><td>D</td><td>S</td></tr></table>")
    row = files.errata_page(spark, str(tmp_path / "e.html")).first()
    assert row.title == "T" and len(row.row_key) == 64 and row.row_key != row.row_hash


def test_sheet(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>code</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row></sheetData></worksheet>')
    assert files.sheet(spark, str(tmp_path / "s.xlsx")).first().cells == ["code", None, "5"]


def test_inventory(spark):
    good = '[[artifact]]\nkey="a"\nprograms=["p","q"]\nurl="u"\n'
    assert files.inventory(spark, good).first().profile == "flatfile"
    with pytest.raises(ValueError):
        files.inventory(spark, good + good)


def test_api_payload(spark):
    rows = [('{"Results":{"series":[{"data":[{"value":"1"},{"value":"2"}]}]}}',), ('{"Results":{"series":[]}}',), ("{}",), (None,)]
    got = files.api_payload(spark.createDataFrame(rows, "payload string")).collect()
    assert [(r.n_series, r.n_points, r.success) for r in got] == [(1, 2, True), (0, 0, False), (0, 0, False), (0, 0, False)]
