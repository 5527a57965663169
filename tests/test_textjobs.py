"""The dataflows over text files, on the fixture lines of FIXTURES.md."""

from __future__ import annotations

import os
import subprocess
import sys

from fixture_data import (AGE_P2, AGE_P7, HEIGHTS, HEIGHTS_P12, MEN_H, MEN_IDS, MINUTE, PASS_MARKS, SCORES, SEX_P2, SEX_P7, SEX_P9,
                          T0, T6, WOMEN_H, WOMEN_IDS, graded_lines, left_at_lines, measured_at_lines, p2_lines, p3_second_file,
                          person_lines, scored_lines)
from tidemark.plans.textjobs import DATAFLOWS

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write(tmp_dir, name, lines, trailing_blank=False):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n" + ("\n" if trailing_blank else ""))
    return p


def test_union_and_pass_marks(spark, tmp_dir):
    a, b = write(tmp_dir, "a.txt", p2_lines()), write(tmp_dir, "b.txt", p3_second_file())
    assert sorted(r.id for r in DATAFLOWS["union"](spark, a, b).collect()) == ["1", "2", "2", "3", "3", "4", "5"]

    s = scored_lines()
    log = write(tmp_dir, "arrivals.txt", [s[0], s[1], "560", s[2], "600", s[3], s[4]])
    rows = DATAFLOWS["pass-marks"](spark, log).orderBy("seq").collect()
    assert [(r.subject.id if r.subject else None, r.label) for r in rows] == [
        ("1", "pass"), ("2", "pass"), (None, "change passing score"), ("3", "not pass"),
        (None, "change passing score"), ("4", "not pass"), ("5", "pass")]


def test_global_windows_drop_late(spark, tmp_dir):
    p = write(tmp_dir, "left.txt", left_at_lines() + [f"12,p12,m,20,{T6 + 2}"])
    rows = DATAFLOWS["global-windows"](spark, p).collect()
    got = sorted((int(r.window_start.timestamp() * 1000) - T6, [m.id for m in r.members]) for r in rows)
    assert got == [(0, ["1", "2", "3", "4", "5"]), (5, ["6", "7", "8", "9", "10"]), (10, ["11"])]


def test_evicting_height_and_running(spark, tmp_dir):
    p = write(tmp_dir, "p12.txt", measured_at_lines(["m"] * 17, HEIGHTS_P12), trailing_blank=True)
    means = [round(r.mean, 6) for r in DATAFLOWS["evicting-height"](spark, p).orderBy("window_start", "firing")
             .collect()]
    assert means == [167.666667, 175.2, 182.0, 162.666667, 167.25, 168.166667, 172.833333, 159.0]
    q = write(tmp_dir, "p10.txt", [f"{i},p{i},{s},20,{h}" for i, (s, h) in enumerate(zip(SEX_P9, HEIGHTS), 1)])
    assert round(DATAFLOWS["running-height"](spark, q).orderBy("seq").collect()[-1].mean, 6) == 170.125


def test_height_join_messages(spark, tmp_dir):
    men = write(tmp_dir, "men.txt", graded_lines(MEN_IDS, MEN_H, "m"))
    women = write(tmp_dir, "women.txt", graded_lines(WOMEN_IDS, WOMEN_H, "f"))
    rows = DATAFLOWS["height-join"](spark, men, women).collect()
    assert len(rows) == 39
    first = [r.message for r in rows if r.l_id == "1" and r.r_id == "5"][0]
    assert first == ("male student[id:1,name:p1,height:168,arriveTime:1,618,838,690,000] is short than "
                     "female student[id:5,name:p5,height:177,arriveTime:1,618,838,750,000]")


def test_pass_marks_from_two_files(spark, tmp_dir):
    """Line k of marks and students arrive in turn, the mark first."""
    students, marks = write(tmp_dir, "s.txt", scored_lines()), write(tmp_dir, "m.txt", [str(m) for m in PASS_MARKS])
    rows = DATAFLOWS["pass-marks"](spark, students, marks).orderBy("seq").collect()
    assert [(r.subject.id if r.subject else None, r.threshold, r.label) for r in rows] == [
        (None, 560, "change passing score"), ("1", 560, "not pass"), (None, 600, "change passing score"), ("2", 600, "pass"),
        (None, 650, "change passing score"), ("3", 650, "not pass"), ("4", 650, "not pass"), ("5", 650, "not pass")]


def test_people_and_split(spark, tmp_dir):
    rows = DATAFLOWS["people"](spark, write(tmp_dir, "p.txt", p2_lines())).orderBy("seq").collect()
    assert [(r.id, r.sex, r.age) for r in rows] == [(str(i + 1), s, a) for i, (s, a) in enumerate(zip(SEX_P2, AGE_P2))]
    rows = DATAFLOWS["split"](spark, write(tmp_dir, "s.txt", scored_lines())).orderBy("seq").collect()
    assert [(r.id, r.route) for r in rows] == [
        (str(i + 1), "admitted" if x > 600 else "not admitted") for i, x in enumerate(SCORES)]


def test_oldest_by_sex(spark, tmp_dir):
    p = write(tmp_dir, "p7.txt", person_lines(SEX_P7, AGE_P7))
    got = [r.leader.id for r in DATAFLOWS["oldest"](spark, p).orderBy("seq").collect()]
    best, want = {}, []
    for i, (s, a) in enumerate(zip(SEX_P7, AGE_P7), start=1):
        if s not in best or a > best[s][0]:
            best[s] = (a, str(i))
        want.append(best[s][1])
    assert got == want


def _five_minutes(heights=HEIGHTS):
    groups = {}
    for n, (s, h) in enumerate(zip(SEX_P9, heights)):
        start = (T0 + n * MINUTE) // (5 * MINUTE) * 5 * MINUTE
        groups.setdefault((s, start), []).append((str(n + 1), float(h)))
    return groups


def _key(r):
    return r.sex, int(r.window_start.timestamp() * 1000)


def test_window_dataflows(spark, tmp_dir):
    p, groups = write(tmp_dir, "p9.txt", measured_at_lines(SEX_P9, HEIGHTS)), _five_minutes()
    means = {_key(r): r["mean"] for r in DATAFLOWS["mean-height"](spark, p).collect()}
    assert means == {k: sum(h for _, h in v) / len(v) for k, v in groups.items()}
    report = {_key(r): (r.highest.id, r.lowest.id, r.n) for r in DATAFLOWS["window-report"](spark, p).collect()}
    assert report == {k: (max(v, key=lambda x: x[1])[0], min(v, key=lambda x: x[1])[0], len(v)) for k, v in groups.items()}
    members = {_key(r): [(m.id, m.height) for m in r.members] for r in DATAFLOWS["window-members"](spark, p).collect()}
    assert members == groups


def test_early_height(spark, tmp_dir):
    p, groups = write(tmp_dir, "p11.txt", measured_at_lines(["m"] * 12, HEIGHTS)), {}
    for (_, start), v in _five_minutes().items():
        groups.setdefault(start, []).extend(v)
    want = []
    for start, v in groups.items():
        v = [h for _, h in sorted(v, key=lambda x: int(x[0]))]
        want += [(start, "early", n, sum(v[:n]) / n) for n in range(4, len(v) + 1)] + [(start, "final", len(v), sum(v) / len(v))]
    rows = DATAFLOWS["early-height"](spark, p).collect()
    assert sorted((int(r.window_start.timestamp() * 1000), r.firing, r.n, r["mean"]) for r in rows) == sorted(want)


def test_command_line(tmp_dir):
    p = write(tmp_dir, "lines.txt", ["alpha", "beta gamma"])
    env = dict(os.environ, PYTHONPATH=REPO)
    out = subprocess.run([sys.executable, "-m", "tidemark", "lines", p], capture_output=True, text=True,
                         env=env, timeout=300, cwd=tmp_dir)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "beta gamma" in out.stdout
    q = write(tmp_dir, "more.txt", [f"line {i}" for i in range(1500)])
    out = subprocess.run([sys.executable, "-m", "tidemark", "lines", p, q], capture_output=True, text=True,
                         env=env, timeout=300, cwd=tmp_dir)
    assert out.returncode == 0 and sum(x.startswith("line ") for x in out.stdout.splitlines()) == 1500  # no row is cut off
