"""Funnel and coaching queries."""

from pyspark.sql import DataFrame

from tidemark.operators import funnel
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables, checklist

_CHECKLIST = """
    SELECT user_id AS learner, CASE WHEN largest > 200 THEN 'major' ELSE 'non-major' END AS track,
           errors >= 18 AS help, day, task_seq, task, n >= 13 AS done
    FROM (SELECT user_id, max(value) AS largest, count(*) FILTER (event_type = 'error') AS errors
          FROM events GROUP BY 1)
    JOIN (SELECT user_id, day, task_seq, task, count(*) FILTER (event_type = task) AS n
          FROM events, (VALUES (1, 'day1', 'view'), (2, 'day1', 'click'), (3, 'day2', 'signup'),
                               (4, 'day2', 'purchase')) AS s(task_seq, day, task)
          GROUP BY ALL) USING (user_id)"""
_COUNTS = f"""
    SELECT task_seq, day, task, count(*) FILTER (done) AS done, count(*) AS learners,
           count(*) FILTER (done) / count(*) AS rate
    FROM ({_CHECKLIST}) GROUP BY ALL"""
_FUNNEL = f"""
    SELECT *, coalesce(done - lag(done) OVER (ORDER BY task_seq), 0) AS change,
           rate = min(rate) OVER () AS hot_spot
    FROM ({_COUNTS})"""
_SCORE = f"""
    SELECT learner, track, help, day1_done, day2_done, done, done / 4 * 100 AS progress_pct,
           round(50 * (1 - done / 4) + 20 * (1 - day2_done / 2) + 30 * help::integer, 1) AS risk,
           done = 4 AS finished
    FROM (SELECT learner, track, bool_or(help) AS help,
                 count(*) FILTER (done AND day <> 'day2') AS day1_done,
                 count(*) FILTER (done AND day = 'day2') AS day2_done, count(*) FILTER (done) AS done
          FROM ({_CHECKLIST}) GROUP BY ALL)"""
_GRADE = f"""
    SELECT *, CASE WHEN risk >= 40 THEN '우선코칭' WHEN risk >= 20 THEN '관찰' ELSE '안정' END AS grade
    FROM ({_SCORE})"""


def _graded(t: Tables) -> DataFrame:
    return funnel.coach_grade(funnel.coach_score(checklist(t.events)))


@query("funnel", _FUNNEL)
def task_funnel(t: Tables) -> DataFrame:
    return funnel.funnel(checklist(t.events))


@query("bottom_tasks", f"SELECT * FROM ({_FUNNEL}) ORDER BY rate, task_seq LIMIT 3")
def bottom_tasks(t: Tables) -> DataFrame:
    return funnel.bottom_tasks(funnel.funnel(checklist(t.events)))


@query("coach_score", _SCORE)
def coach_score(t: Tables) -> DataFrame:
    return funnel.coach_score(checklist(t.events))


@query("coaching_priority", f"""
    SELECT learner AS "이름", track AS "트랙", help AS "도움요청", day1_done AS "day1_완료",
           day2_done AS "day2_완료", done AS "전체_완료", progress_pct AS "진도율", risk AS "위험점수",
           grade AS "등급"
    FROM ({_GRADE})""")
def coaching_priority(t: Tables) -> DataFrame:
    return funnel.coaching_priority(_graded(t))


@query("coach_names", f"""
    SELECT row_number() OVER (ORDER BY risk DESC, learner) AS place, learner
    FROM ({_GRADE}) WHERE grade = '우선코칭'""")
def coach_names(t: Tables) -> DataFrame:
    return funnel.coach_names(_graded(t))


@query("coach_kpis", f"""
    SELECT avg(progress_pct) AS mean_progress_pct, count(*) FILTER (finished) AS finished_all,
           count(*) FILTER (help) AS help_requests, (SELECT min(rate) FROM ({_COUNTS})) AS lowest_task_rate
    FROM ({_GRADE})""")
def coach_kpis(t: Tables) -> DataFrame:
    return funnel.coach_kpis(_graded(t), funnel.funnel(checklist(t.events)))
