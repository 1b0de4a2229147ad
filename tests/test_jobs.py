"""The runnable jobs end to end on the reference jobs' own inputs."""

import os

import pytest

from tests import fixtures as X
from tidepool import jobs
from tidepool.functions.parse import TXN_LINE


def _write(path, lines, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def _lines(spark, folder):
    return [r["value"] for r in spark.read.text(folder).collect()]


def test_word_count_job(spark, scratch):
    src = _write(f"{scratch}/in/input.txt", X.WORDS)
    jobs.word_count_job(spark, src, f"{scratch}/out")
    assert sorted(_lines(spark, f"{scratch}/out")) == ["NeW 1", "New 2", "None 1"]


def test_avg_profit_job_keeps_line_order(spark, scratch):
    src = _write(f"{scratch}/in/avg.txt", X.SALE_LINES)
    out = jobs.avg_profit_job(spark, src)
    assert [(r["month"], r["running_avg"]) for r in out.collect()] == X.SALE_RUNNING_AVG


def test_split_job(spark, scratch):
    src = _write(f"{scratch}/in/oddeven.txt", [str(v) for v in X.INTEGERS])
    outs = jobs.split_job(spark, src)
    assert [r[0] for r in outs["even"].collect()] == X.EVEN_EXPECTED
    assert [r[0] for r in outs["odd"].collect()] == X.ODD_EXPECTED


def test_split_job_whole_input(spark, scratch):
    outs = jobs.split_job(spark, _write(f"{scratch}/in/all.txt", [str(v) for v in X.ALL_INTEGERS]))
    assert [r[0] for r in outs["even"].collect()] == X.ALL_EVEN
    assert [r[0] for r in outs["odd"].collect()] == X.ALL_ODD


def test_cab_job(spark, scratch):
    trips = ["c1,P1,suv,Ann,yes,Airport,Mall,3", "c2,P2,mini,Bob,no,Airport,Mall,bad",
             "c3,P3,suv,Cid,yes,Airport,Park,5", "c4,P4,mini,Dee,yes,Station,Mall,2"]
    outs = jobs.cab_job(spark, _write(f"{scratch}/in/cab.txt", trips))
    assert [(r["destination"], r["trips"]) for r in outs["trips_by_destination"].collect()] == [
        ("Mall", 1), ("Park", 1), ("Mall", 2)]
    assert [(r["pickup"], r["avg_passengers"]) for r in outs["avg_passengers_by_pickup"].collect()] == [
        ("Airport", 3.0), ("Airport", 4.0), ("Station", 2.0)]


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, before)


@pytest.mark.parametrize("files", [1, 1000])
def test_bank_job_city_changes_in_any_zone(spark, scratch, zone, files):
    def line(i, city):
        cols = X.TXN_LINES[0].split(",")
        return ",".join({"txn_id": f"t{i}", "txn_ts": f"2021-03-05 10:00:0{i}", "city": city, "customer_id": "id_move"}.get(n, v)
                        for (n, _), v in zip(TXN_LINE, cols))
    _write(f"{scratch}/txns/a.txt", [line(1, "Pune"), line(2, "Goa")], 1_700_000_000)
    _write(f"{scratch}/txns/b.txt", [line(3, "Pune"), line(4, "Pune")], 1_700_000_010)
    alarmed = _write(f"{scratch}/alarmed.txt", X.ALARMED_LINES)
    lost = _write(f"{scratch}/lost.txt", X.LOST_CARD_LINES)
    jobs.bank_job(spark, f"{scratch}/txns", alarmed, lost, f"{scratch}/out", window="10 minutes", files_per_trigger=files)
    moved = [g for g in _lines(spark, f"{scratch}/out") if "id_move" in g and ("10:00:03" in g or "10:00:04" in g)]
    assert len(moved) >= 2


def test_bank_job_alert_lines(spark, scratch, zone):
    half = len(X.TXN_LINES) // 2
    _write(f"{scratch}/txns/a.txt", X.TXN_LINES[:half], 1_700_000_000)
    _write(f"{scratch}/txns/b.txt", X.TXN_LINES[half:], 1_700_000_010)
    alarmed = _write(f"{scratch}/alarmed.txt", X.ALARMED_LINES)
    lost = _write(f"{scratch}/lost.txt", X.LOST_CARD_LINES)
    jobs.bank_job(spark, f"{scratch}/txns", alarmed, lost, f"{scratch}/out", window="10 minutes")
    got = _lines(spark, f"{scratch}/out")
    for line in X.FLAGGED_LINES:
        assert line in got
    assert sum("ALARMED" in g for g in got) == len(X.ALARMED_TXN_IDS)
    assert sum("LOST card" in g for g in got) == len(X.LOST_TXN_IDS)


@pytest.mark.parametrize("parts", [1, 4])
def test_bank_job_whole_input_gives_the_golden_member_alerts(spark, scratch, parts):
    size = -(-len(X.ALL_TXN_LINES) // parts)
    for i in range(parts):
        _write(f"{scratch}/txns/{i}.txt", X.ALL_TXN_LINES[i * size:(i + 1) * size], 1_700_000_000 + 10 * i)
    alarmed = _write(f"{scratch}/alarmed.txt", X.ALL_ALARMED_LINES)
    lost = _write(f"{scratch}/lost.txt", X.ALL_LOST_CARD_LINES)
    jobs.bank_job(spark, f"{scratch}/txns", alarmed, lost, f"{scratch}/out", window="1 hour")
    got = _lines(spark, f"{scratch}/out")
    assert sorted(g for g in got if "ALARMED" in g or "LOST card" in g) == sorted(X.ALL_MEMBER_ALERTS)


def _txn(txn_id, at, customer, card):
    cols = X.TXN_LINES[0].split(",")
    changed = {"txn_id": txn_id, "txn_ts": f"2021-03-05 10:00:{at:02d}", "customer_id": customer, "card_id": card}
    return ",".join(changed.get(n, v) for (n, _), v in zip(TXN_LINE, cols))


def test_bank_job_lists_change_while_it_runs(spark, scratch, monkeypatch):
    _write(f"{scratch}/txns/a.txt", [_txn("t1", 1, "id_new", "c_1"), _txn("t2", 2, "id_old", "c_2")], 1_700_000_000)
    _write(f"{scratch}/txns/b.txt", [_txn("t3", 3, "id_new", "c_1"), _txn("t4", 4, "id_x", "c_lost")], 1_700_000_010)
    _write(f"{scratch}/alarmed/a.txt", ["id_old,acc_1"])
    _write(f"{scratch}/lost/a.txt", ["c_none,2021-03-05 09:00:00,Ann,Lost"])
    flag, calls = jobs.rules.flag_members_many, []

    def flag_then_add(*args):
        found = flag(*args)
        if not calls:  # new list lines arrive after the first micro-batch has read the lists
            _write(f"{scratch}/alarmed/b.txt", ["id_new,acc_2"])
            _write(f"{scratch}/lost/b.txt", ["c_lost,2021-03-05 09:30:00,Bob,Lost"])
        calls.append(1)
        return found

    monkeypatch.setattr(jobs.rules, "flag_members_many", flag_then_add)
    args = (spark, f"{scratch}/txns", f"{scratch}/alarmed", f"{scratch}/lost", f"{scratch}/out")
    assert jobs.bank_job(*args, files_per_trigger=1) == 0
    found = [g for g in _lines(spark, f"{scratch}/out") if "ALARMED" in g or "LOST card" in g]
    assert [[t for t in ("t1", "t2", "t3", "t4") if f"{t}," in g] for g in sorted(found)] == [["t4"], ["t3"], ["t2"]]
    jobs.bank_job(*args, files_per_trigger=1)  # nothing new: nothing is written again
    again = [g for g in _lines(spark, f"{scratch}/out") if "ALARMED" in g or "LOST card" in g]
    assert sorted(again) == sorted(found)


def test_stock_job_minute_report(spark, scratch, zone):
    ticks = []
    for line in X.MINUTE_REPORT:
        span, mx, mn, _, vmx, vmn, _ = [s.strip() for s in line.split(",")]
        start, end = [s.strip() for s in span.split(" - ")]
        ticks.append(start.replace(":", ",", 1) + f",{mx},{vmn}")
        ticks.append(end.replace(":", ",", 1) + f",{mn},{vmx}")
    _write(f"{scratch}/ticks/t1.txt", ticks, 1_700_000_000)
    _write(f"{scratch}/ticks/t2.txt", ["06/10/2010,09:00:00,100.0,1"], 1_700_000_010)
    jobs.stock_job(spark, f"{scratch}/ticks", f"{scratch}/out")
    assert sorted(_lines(spark, f"{scratch}/out/report")) == sorted(X.MINUTE_REPORT)


def test_stock_job_tells_late_ticks(spark, scratch):
    _write(f"{scratch}/ticks/t1.txt", ["06/10/2010,08:00:00,100.0,5", "06/10/2010,08:30:00,101.0,6"], 1_700_000_000)
    assert jobs.stock_job(spark, f"{scratch}/ticks", f"{scratch}/out") == 0
    _write(f"{scratch}/ticks/t2.txt", ["06/10/2010,08:00:30,300.0,7", "06/10/2010,09:00:00,102.0,8"], 1_700_000_010)
    with pytest.warns(UserWarning, match="stock: 2 rows came after"):
        assert jobs.stock_job(spark, f"{scratch}/ticks", f"{scratch}/out") == 2
    got = _lines(spark, f"{scratch}/out/report")
    assert len(got) == 2 and not any("300.0" in g for g in got)


def test_word_count_stream_job_per_record(spark, scratch):
    _write(f"{scratch}/lines/a.txt", X.WORDS[:3], 1_700_000_000)   # xinchao New None
    _write(f"{scratch}/lines/b.txt", X.WORDS[3:], 1_700_000_010)   # Tokyo New NeW
    jobs.word_count_stream_job(spark, f"{scratch}/lines", f"{scratch}/out")
    assert sorted(_lines(spark, f"{scratch}/out")) == ["(NeW,1)", "(New,1)", "(New,2)", "(None,1)"]
