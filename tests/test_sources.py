import pytest

from codays.operators.clean import parse_events, reject_audit
from codays.operators.grid import grid_cells
from codays.sources.csv_events import bind_columns, load_events, read_event_csv

from brute import rows

DIRTY = """latitude,longitude,date
37.5,15.3,2024-03-12
"",15.3,2024-03-12
,15.3,2024-03-12
abc,15.3,2024-03-12
37.5,15.3
37.5,15.3,2024-03-12,extra
37.5,15.3,2024-03
 37.5 ,15.3, 2024-03-12

1d,2f,2024-03-12T00:00:00Z
NaN,Infinity,2024-03-12
nan,inf,2024-03-12
0x1p3,1e400,2024-03-12
0x1p3,1.0,notadate!!x
999.95,-0.04,2024-03-12
"""


@pytest.fixture
def csv(tmp_path):
    def write(text):
        path = tmp_path / "events.csv"
        path.write_text(text)
        return str(path)

    return write


def test_scan_reads_strings_and_pads_short_rows(spark, csv):
    raw = read_event_csv(spark, csv(DIRTY))
    assert [f.dataType.simpleString() for f in raw.schema] == ["string"] * 3
    assert raw.count() == 14
    assert raw.where("date is null").count() == 1


def test_dirty_rows(spark, csv):
    events = parse_events(load_events(spark, csv(DIRTY)))
    assert rows(events) == sorted(
        [
            (37.5, 15.3, "2024-03-12"),
            (37.5, 15.3, "2024-03-12"),
            (37.5, 15.3, " 2024-03-1"),
            (1.0, 2.0, "2024-03-12"),
            (8.0, 1.0, "notadate!!"),
            (999.95, -0.04, "2024-03-12"),
        ]
    )


def test_edge_values_reach_the_grid(spark, csv):
    cells = grid_cells(parse_events(load_events(spark, csv(DIRTY))))
    cell = cells.where("lat > 999").first()
    assert (cell.lat, str(cell.lon)) == (1000.0, "0.0")


def test_every_dropped_row_is_counted(spark, csv):
    audit = dict(rows(reject_audit(load_events(spark, csv(DIRTY)))))
    assert audit == {
        "latitude missing": 2,
        "latitude not a number": 1,
        "latitude not finite": 2,
        "longitude not finite": 1,
        "date missing": 1,
        "date too short": 1,
    }


def test_other_layout_binds_by_position_and_keeps_nothing(spark, csv):
    path = csv("time,latitude,longitude,depth,mag\n2024-03-12 02:10:00,37.5,15.3,8.0,3.1\n")
    raw = load_events(spark, path)
    assert raw.first().latitude == "2024-03-12 02:10:00"
    assert parse_events(raw).count() == 0


def test_name_fills_only_a_null_position(spark, csv):
    path = csv("x,longitude,date,latitude\n,15.3,2024-03-12,37.5\nbad,15.3,2024-03-12,37.5\n")
    assert [r.latitude for r in load_events(spark, path).collect()] == ["37.5", "bad"]


def test_name_is_matched_exactly(spark):
    raw = spark.createDataFrame([(None, "1", "2024-03-12", "9")], "a string, b string, c string, Latitude string")
    assert bind_columns(raw).first().latitude is None


def test_names_with_dots(spark):
    raw = spark.createDataFrame([("1", "2", "2024-03-12")], "`a.b` string, `c.d` string, `e.f` string")
    assert tuple(bind_columns(raw).first()) == ("1", "2", "2024-03-12")


def test_too_few_columns_keep_nothing(spark):
    raw = spark.createDataFrame([("1", "2")], "latitude string, longitude string")
    bound = bind_columns(raw)
    assert bound.count() == 1
    assert parse_events(bound).count() == 0


def test_extra_columns_are_not_read(spark, csv):
    path = csv("latitude,longitude,date,depth\n1,2,2024-03-12,9\n")
    plan = load_events(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<latitude:string,longitude:string,date:string>" in plan
