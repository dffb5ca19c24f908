import pytest

from tests.conftest import rows
from tests.fixtures import COACHING, FUNNEL
from tidemark.operators import funnel


@pytest.fixture(scope="module")
def checklist(spark):
    data = []
    for learner, track, asked, day1, day2, *_ in COACHING:
        for seq in range(1, 15):
            day, place, done = ("day1", seq, day1) if seq <= 7 else ("day2", seq - 7, day2)
            data.append((learner, track, asked, day, seq, f"task{seq}", place <= done))
    return spark.createDataFrame(
        data, "learner STRING, track STRING, help BOOLEAN, day STRING, task_seq INT, task STRING, done BOOLEAN")


def test_funnel_counts_and_changes(checklist):
    got = rows(funnel.funnel(checklist), "done", "change", "hot_spot")
    assert [g[0] for g in got] == FUNNEL
    assert [g[1] for g in got] == [0] + [b - a for a, b in zip(FUNNEL, FUNNEL[1:])]
    assert [i for i, g in enumerate(got) if g[2]] == [12, 13]


def test_bottom_tasks_prefer_earlier_ones(checklist):
    assert [r[0] for r in rows(funnel.bottom_tasks(funnel.funnel(checklist)), "task_seq")] == [13, 14, 11]


def test_scores_and_grades(checklist):
    listed = funnel.coaching_priority(funnel.coach_grade(funnel.coach_score(checklist)))
    got = rows(listed)
    want = [(n, t, h, d1, d2, d1 + d2, p, r, g) for n, t, h, d1, d2, p, r, g in COACHING]
    assert [g[:6] + g[7:] for g in got] == [w[:6] + w[7:] for w in want]
    assert [g[6] for g in got] == pytest.approx([w[6] for w in want])
    assert listed.columns[0] == "이름"


def test_names_and_headline_figures(checklist):
    graded = funnel.coach_grade(funnel.coach_score(checklist))
    assert rows(funnel.coach_names(graded).orderBy("place")) == [(1, "L01"), (2, "L02")]
    kpis = funnel.coach_kpis(graded, funnel.funnel(checklist)).first()
    assert round(kpis["mean_progress_pct"]) == 68
    assert (kpis["finished_all"], kpis["help_requests"], kpis["lowest_task_rate"]) == (2, 1, 0.2)
