"""The registered queries in plain SQL, for comparison on another engine.

Constants are spelled out instead of taken from the specification, so that a
wrong constant there shows up as a difference.
"""

from __future__ import annotations

_MARKS = """
marks AS (
  SELECT l_orderkey, count(*) AS n,
         sum(CAST(round(l_quantity * 2) AS BIGINT)) AS q,
         sum(CAST(round(l_discount * 1000) AS BIGINT)) AS d,
         sum(CAST(round(l_tax * 1250) AS BIGINT)) AS t
  FROM lineitem GROUP BY l_orderkey
),
records AS (
  SELECT o_orderkey AS Student_ID, c_name AS Name, c_mktsegment AS Gender,
         (5000 + (CAST(round(o_totalprice * 100) AS BIGINT) + 5000) // 10000) / 100
           AS Attendance,
         CAST(1 + day(o_orderdate) % 8 AS DOUBLE) AS Study_Hours,
         CAST(q AS DOUBLE) / n AS Math,
         CAST(d AS DOUBLE) / n AS Science,
         CAST(t AS DOUBLE) / n AS English,
         o_orderstatus
  FROM orders
  LEFT JOIN marks ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
),
means AS (
  SELECT *, (Math + Science + English) / 3 AS mean FROM records
),
averaged AS (
  SELECT *, CAST(round(CAST(mean AS DECIMAL(18, 10)), 2) AS DOUBLE) AS Average FROM means
),
scored AS (
  SELECT *,
         CASE WHEN Average >= 90 THEN 'A' WHEN Average >= 80 THEN 'B'
              WHEN Average >= 70 THEN 'C' WHEN Average >= 60 THEN 'D'
              ELSE 'F' END AS Grade,
         CASE WHEN Average >= 40 THEN 'PASS' ELSE 'FAIL' END AS Status,
         CASE WHEN mean < 40 OR Attendance < 55 OR (Study_Hours < 2 AND mean < 55)
              THEN 'High support'
              WHEN mean < 60 OR Attendance < 75 OR Study_Hours < 3
              THEN 'Moderate support'
              ELSE 'On track' END AS Support_Category,
         CASE WHEN Attendance < 75 AND Average < 50 THEN 'High support'
              WHEN Attendance < 75 OR Average < 50 THEN 'Moderate support'
              ELSE 'On track' END AS Flag_Category
  FROM averaged
)
"""

_WITH = f"WITH {_MARKS}"

# Each event read as a submitted record; verdicts follow the order of event ids.
_VERDICTS = r"""
fields AS (
  SELECT event_id AS Ingest_Order, event_type AS kind, user_id, value,
         TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k
  FROM events
),
parsed AS (
  SELECT CASE WHEN kind <> 'error' THEN user_id END AS Student_ID,
         CASE WHEN kind = 'view' THEN '' ELSE kind || ' ' || user_id END AS Name,
         kind AS Gender, value AS Attendance, k / 4 AS Study_Hours, k AS Math,
         99 - k AS Science, CASE WHEN kind <> 'click' THEN k END AS English,
         Ingest_Order
  FROM fields
),
judged AS (
  SELECT *,
         CASE WHEN Attendance IS NULL OR Study_Hours IS NULL OR Math IS NULL
                OR Science IS NULL OR English IS NULL
              THEN 'Please enter valid numeric values.'
              WHEN Name = '' THEN 'Name cannot be empty.'
              WHEN Attendance < 0 OR Attendance > 100
              THEN 'Attendance must be between 0 and 100.'
              WHEN Study_Hours < 0 THEN 'Study hours cannot be negative.'
              WHEN Study_Hours > 24 THEN 'Study hours must not exceed 24.'
              WHEN least(Math, Science, English) < 0 OR greatest(Math, Science, English) > 100
              THEN 'Marks must be between 0 and 100.' END AS fault,
         CASE WHEN Student_ID IS NULL THEN 'Please enter valid numeric values.'
              WHEN Student_ID < 1 THEN 'Student ID must be at least 1.' END AS key_fault
  FROM parsed
),
firsts AS (
  SELECT Student_ID AS first_id, min(Ingest_Order) AS first_order
  FROM judged WHERE fault IS NULL AND key_fault IS NULL GROUP BY Student_ID
),
verdicts AS (
  SELECT judged.*,
         coalesce(key_fault,
                  CASE WHEN Student_ID IN (SELECT o_orderkey FROM orders
                                           WHERE o_orderstatus = 'F')
                         OR Ingest_Order > first_order
                       THEN 'Student ID already exists!' END,
                  fault) AS Reject_Reason
  FROM judged LEFT JOIN firsts ON first_id = Student_ID
)
"""

_RECORD = "Student_ID, Name, Gender, Attendance, Study_Hours, Math, Science, English"
_SCORED = f"{_RECORD}, Average, Grade, Status"
_RISK = "Attendance < 75 OR Average < 50"

_GRADES = "(VALUES ('A'), ('B'), ('C'), ('D'), ('F'))"
_CLASSES = "(VALUES ('High support'), ('Moderate support'), ('On track'))"

_COUNTS = f"""
classes AS (
  SELECT label,
         (SELECT count(*) FROM scored WHERE Support_Category = label
            AND Flag_Category = label) AS tp,
         (SELECT count(*) FROM scored WHERE Flag_Category = label) AS p,
         (SELECT count(*) FROM scored WHERE Support_Category = label) AS s
  FROM {_CLASSES} AS c(label)
),
measured AS (
  SELECT *, CASE WHEN p = 0 THEN 0.0 ELSE tp / p END AS pr,
         CASE WHEN s = 0 THEN 0.0 ELSE tp / s END AS re,
         CASE WHEN p + s = 0 THEN 0.0 ELSE 2 * tp / (p + s) END AS f1
  FROM classes
),
overall AS (
  SELECT count(*) AS n,
         count(*) FILTER (Support_Category = Flag_Category) / count(*) AS acc
  FROM scored
)
"""
_METRICS = f"""
metrics AS (
  SELECT round(any_value(acc), 6) AS Accuracy,
         round(coalesce(avg(pr) FILTER (p + s > 0), 0), 6) AS "Precision",
         round(coalesce(avg(re) FILTER (p + s > 0), 0), 6) AS Recall,
         round(coalesce(avg(f1) FILTER (p + s > 0), 0), 6) AS F1_Score,
         any_value(n) AS Samples
  FROM measured, overall
)
"""

_SUGGESTIONS = """
(VALUES
  ('High support', 1, 'Review the topics with the lowest marks with a teacher or tutor.'),
  ('High support', 2, 'Build a manageable daily study routine and practise regularly.'),
  ('High support', 3, 'Check attendance barriers and seek help if classes are being missed.'),
  ('Moderate support', 1, 'Focus practice on the weakest subject.'),
  ('Moderate support', 2, 'Aim for consistent attendance and review notes weekly.'),
  ('Moderate support', 3, 'Track quiz results to see whether your study plan is helping.'),
  ('On track', 1, 'Maintain the current study routine and attendance.'),
  ('On track', 2, 'Practise challenging questions to deepen understanding.'),
  ('On track', 3, 'Review progress regularly rather than relying on one prediction.'))
"""

_LONG_MARKS = """
long_marks AS (
  SELECT 'Math' AS Subject, Student_ID, Name, Math AS Mark FROM scored
  UNION ALL SELECT 'Science', Student_ID, Name, Science FROM scored
  UNION ALL SELECT 'English', Student_ID, Name, English FROM scored
)
"""

_TOP = f"""{_WITH}
SELECT Student_ID, Name, Average, Grade, Status FROM scored
ORDER BY Average DESC NULLS LAST, Student_ID LIMIT 5"""

_AT_RISK = f"""{_WITH}
SELECT Student_ID, Name, Attendance, Average, Grade, Status FROM scored WHERE {_RISK}"""

_KPIS = """
kpis AS (
  SELECT count(*) AS n, avg(Average) AS a, avg(Attendance) AS b, avg(Study_Hours) AS c,
         CASE WHEN count(*) = 0 THEN 0.0
              ELSE 100.0 * count(*) FILTER (Status = 'PASS') / count(*) END AS r
  FROM scored
)
"""

# Complete records: the share of all, rounded up, shared out by largest remainder.
_SIZES = """
counts AS (
  SELECT Support_Category, count(*) AS n FROM scored WHERE mean IS NOT NULL
  GROUP BY Support_Category
),
quotas AS (
  SELECT *, sum(n) OVER () AS total, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS held
  FROM counts
),
parts AS (SELECT *, CAST(n * held // total AS BIGINT) AS part, n * held % total AS rest FROM quotas),
sizes AS (
  SELECT Support_Category, n, part + CASE WHEN
           row_number() OVER (ORDER BY rest DESC, Support_Category) <= held - sum(part) OVER ()
         THEN 1 ELSE 0 END AS test
  FROM parts
)
"""

_EXPLANATION = """'Entered marks average: ' || printf('%.1f', mean) || '/100; attendance: '
       || printf('%.0f', Attendance) || '%; study time: '
       || printf('%.1f', Study_Hours) || ' hours/day. '
       || 'This is a demonstration prediction based on synthetic data.'"""

ORACLE: dict[str, str] = {
    "scan_base": f"{_WITH} SELECT {_RECORD} FROM records",
    "existing_keys": """
SELECT DISTINCT l_orderkey AS Student_ID FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "new_keys": """
SELECT DISTINCT l_orderkey AS Student_ID FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "append_new": f"""{_WITH}, {_VERDICTS}
SELECT {_RECORD} FROM records WHERE o_orderstatus = 'F'
UNION ALL SELECT {_RECORD} FROM verdicts WHERE Reject_Reason IS NULL""",
    "validate_rejects": f"""WITH {_VERDICTS}
SELECT {_RECORD}, Ingest_Order, Reject_Reason FROM verdicts
WHERE Reject_Reason IS NOT NULL""",
    "score": f"{_WITH} SELECT {_SCORED} FROM scored",
    "average_previews": f"""{_WITH}
SELECT Student_ID, CAST(printf('%.2f', mean) AS DOUBLE) AS Preview FROM scored""",
    "roster_cli": f"""{_WITH}
SELECT Student_ID, Name, Attendance, Study_Hours, Math, Science, English,
       Average, Grade, Status FROM scored ORDER BY Student_ID""",
    "roster_ui": f"{_WITH} SELECT {_SCORED} FROM scored ORDER BY Student_ID",
    "find_by_id": f"{_WITH} SELECT {_SCORED} FROM scored WHERE Student_ID = 7",
    "find_by_ids": f"""{_WITH}
SELECT {_SCORED} FROM scored WHERE Student_ID IN (SELECT user_id FROM events)""",
    "search_regex": f"""{_WITH}
SELECT {_SCORED} FROM scored
WHERE regexp_matches(Name, 'er#0+1[0-9]*7$', 'i')
   OR regexp_matches(CAST(Student_ID AS VARCHAR), 'er#0+1[0-9]*7$', 'i')""",
    "search_literal": f"""{_WITH}
SELECT {_SCORED} FROM scored
WHERE contains(lower(Name), lower('CUSTOMER#00000001'))
   OR contains(CAST(Student_ID AS VARCHAR), lower('CUSTOMER#00000001'))""",
    "low_attendance": f"""{_WITH}
SELECT Student_ID, Name, Attendance FROM records WHERE Attendance < 75""",
    "by_study_hours": f"""{_WITH}
SELECT Student_ID, Name, Study_Hours FROM records
ORDER BY Study_Hours DESC NULLS LAST, Student_ID""",
    "at_risk": _AT_RISK,
    "sql_at_risk": _AT_RISK,
    "at_risk_reason": f"""{_WITH}
SELECT Student_ID, Name, Attendance, Average, Grade,
       CASE WHEN Attendance < 75 AND Average < 50 THEN 'Low attendance and low marks'
            WHEN Attendance < 75 THEN 'Attendance below 75%'
            ELSE 'Average below 50' END AS Reason
FROM scored WHERE {_RISK}""",
    "rel_attendance": f"""{_WITH}
SELECT Student_ID, Name, Attendance, Average, Grade, Study_Hours FROM scored""",
    "rel_study_hours": f"""{_WITH}
SELECT Student_ID, Name, Study_Hours, Average, Grade FROM scored""",
    "top_students": _TOP,
    "sql_top_students": _TOP,
    "top3_per_subject": f"""{_WITH}, {_LONG_MARKS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Subject
                               ORDER BY Mark DESC NULLS LAST, Student_ID) AS Rank
  FROM long_marks
)
SELECT Subject, Rank, Student_ID, Name, Mark FROM ranked WHERE Rank <= 3""",
    "class_statistics": f"""{_WITH}
SELECT count(*) AS Total_Students, round(avg(Average), 2) AS Class_Average,
       round(avg(Math), 2) AS Math_Average, round(avg(Science), 2) AS Science_Average,
       round(avg(English), 2) AS English_Average,
       count(*) FILTER (Status = 'PASS') AS Passed,
       count(*) FILTER (Status = 'FAIL') AS Failed
FROM scored""",
    "subject_averages": f"""{_WITH}
SELECT round(avg(Math), 2) AS Math_Average, round(avg(Science), 2) AS Science_Average,
       round(avg(English), 2) AS English_Average FROM records""",
    "subject_averages_long": f"""{_WITH}, {_LONG_MARKS}
SELECT Subject, round(avg(Mark), 2) AS Average FROM long_marks GROUP BY Subject""",
    "attendance_summary": f"""{_WITH}
SELECT round(avg(Attendance), 2) AS Average_Attendance,
       count(*) FILTER (Attendance >= 75) AS High_Attendance,
       count(*) FILTER (Attendance < 75) AS Low_Attendance FROM records""",
    "study_hours_summary": f"""{_WITH}
SELECT round(avg(Study_Hours), 2) AS Average_Hours, max(Study_Hours) AS Maximum_Hours,
       min(Study_Hours) AS Minimum_Hours FROM records""",
    "dashboard_kpis": f"""{_WITH}, {_KPIS}
SELECT n AS Total_Students, round(a, 1) AS Class_Average,
       round(b, 1) AS Average_Attendance, round(c, 1) AS Average_Study_Hours,
       round(r, 1) AS Pass_Rate FROM kpis""",
    "dashboard_cards": f"""{_WITH}, {_KPIS}
SELECT CAST(n AS VARCHAR) AS Total_Students, printf('%.1f', a) AS Class_Average,
       printf('%.1f', b) || '%' AS Average_Attendance,
       printf('%.1f', c) AS Average_Study_Hours,
       printf('%.1f', r) || '%' AS Pass_Rate FROM kpis""",
    "grade_distribution": f"""{_WITH}
SELECT Grade, count(*) AS Students FROM scored GROUP BY Grade""",
    "status_distribution": f"""{_WITH}
SELECT Status, count(*) AS Students FROM scored GROUP BY Status""",
    "grade_distribution_dense": f"""{_WITH}
SELECT g AS Grade, count(Student_ID) AS Students
FROM {_GRADES} AS d(g) LEFT JOIN scored ON Grade = g GROUP BY g""",
    "status_distribution_dense": f"""{_WITH}
SELECT s AS Status, count(Student_ID) AS Students
FROM (VALUES ('PASS'), ('FAIL')) AS d(s) LEFT JOIN scored ON Status = s GROUP BY s""",
    "attendance_histogram": f"""{_WITH},
binned AS (
  SELECT CAST(least(greatest(floor(Attendance / 10), 0), 9) AS INTEGER) * 10 AS b
  FROM records
),
bins AS (SELECT CAST(i * 10 AS INTEGER) AS low FROM range(10) AS r(i))
SELECT low AS Bin_Start, CAST(low + 10 AS INTEGER) AS Bin_End, count(b) AS Students
FROM bins LEFT JOIN binned ON b = low GROUP BY low""",
    "subject_box": f"""{_WITH}, {_LONG_MARKS},
quartiles AS (
  SELECT Subject, count(*) AS n, min(Mark) AS lo, max(Mark) AS hi,
         quantile_cont(Mark, 0.25) AS q1, quantile_cont(Mark, 0.5) AS q2,
         quantile_cont(Mark, 0.75) AS q3
  FROM long_marks WHERE Mark IS NOT NULL GROUP BY Subject
),
fences AS (
  SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM quartiles
),
reach AS (
  SELECT Subject AS s, min(Mark) FILTER (Mark BETWEEN lf AND uf) AS lw,
         max(Mark) FILTER (Mark BETWEEN lf AND uf) AS uw,
         count(*) FILTER (Mark NOT BETWEEN lf AND uf) AS outside
  FROM long_marks JOIN fences USING (Subject) GROUP BY Subject
)
SELECT Subject, n AS Marks, round(lo, 4) AS Minimum, round(q1, 4) AS Q1,
       round(q2, 4) AS Median, round(q3, 4) AS Q3, round(hi, 4) AS Maximum,
       round(lf, 4) AS Lower_Fence, round(uf, 4) AS Upper_Fence,
       round(lw, 4) AS Lower_Whisker, round(uw, 4) AS Upper_Whisker, outside AS Outliers
FROM fences JOIN reach ON s = Subject""",
    "sql_class_summary": f"""{_WITH}
SELECT count(*) AS Total_Students, round(avg(Average), 2) AS Class_Average,
       round(avg(Attendance), 2) AS Average_Attendance,
       round(avg(Study_Hours), 2) AS Average_Study_Hours FROM scored""",
    "support_label": f"""{_WITH}
SELECT Student_ID, Attendance, Study_Hours, Math, Science, English, Support_Category
FROM scored""",
    "support_distribution": f"""{_WITH}
SELECT Support_Category, count(*) AS Students FROM scored GROUP BY Support_Category""",
    "split_sizes": f"""{_WITH}, {_SIZES}
SELECT Support_Category, n - test AS Training_Samples, test AS Test_Samples FROM sizes""",
    "sample_counts": f"""{_WITH}, {_SIZES}
SELECT CAST(sum(n - test) AS BIGINT) AS Training_Samples,
       CAST(sum(test) AS BIGINT) AS Test_Samples,
       (SELECT count(*) FILTER (mean IS NULL) FROM scored) AS Left_Out FROM sizes""",
    "predict_hours_band": f"""{_WITH},
banded AS (
  SELECT *, CASE WHEN mean IS NULL THEN NULL WHEN Study_Hours <= 3 THEN 'High support'
                 WHEN Study_Hours <= 5 THEN 'Moderate support' ELSE 'On track' END AS band
  FROM scored
),
advice AS (
  SELECT category, string_agg(sentence, ' ' ORDER BY position) AS sentences
  FROM {_SUGGESTIONS} AS a(category, position, sentence) GROUP BY category
)
SELECT Student_ID, band AS Category,
       CASE WHEN band IS NOT NULL THEN {_EXPLANATION} END AS Explanation,
       sentences AS Suggestions
FROM banded LEFT JOIN advice ON category = band""",
    "suggestions": f"""{_WITH}
SELECT Student_ID, Support_Category, CAST(position AS BIGINT) AS Position,
       sentence AS Suggestion
FROM scored JOIN {_SUGGESTIONS} AS a(category, position, sentence)
  ON category = Support_Category""",
    "explain_support": f"""{_WITH}
SELECT Student_ID, {_EXPLANATION} AS Explanation FROM scored""",
    "eval_metrics": f"{_WITH}, {_COUNTS}, {_METRICS} SELECT * FROM metrics",
    "eval_cards": f"""{_WITH}, {_COUNTS}, {_METRICS}
SELECT printf('%.2f', Accuracy * 100) || '%' AS Accuracy,
       printf('%.2f', "Precision" * 100) || '%' AS "Precision",
       printf('%.2f', Recall * 100) || '%' AS Recall,
       printf('%.2f', F1_Score * 100) || '%' AS F1_Score FROM metrics""",
    "confusion_matrix": f"""{_WITH}
SELECT a.label AS Actual, p.label AS Predicted, count(Student_ID) AS Samples
FROM {_CLASSES} AS a(label) CROSS JOIN {_CLASSES} AS p(label)
LEFT JOIN scored ON Support_Category = a.label AND Flag_Category = p.label
GROUP BY a.label, p.label""",
    "confusion_matrix_wide": f"""{_WITH}
SELECT label AS Actual,
       count(*) FILTER (Flag_Category = 'High support') AS "High support",
       count(*) FILTER (Flag_Category = 'Moderate support') AS "Moderate support",
       count(*) FILTER (Flag_Category = 'On track') AS "On track"
FROM {_CLASSES} AS c(label) LEFT JOIN scored ON Support_Category = label
GROUP BY label""",
    "classification_report": f"""{_WITH}, {_COUNTS}
SELECT label AS Label, round(pr, 6) AS "Precision", round(re, 6) AS Recall,
       round(f1, 6) AS F1_Score, s AS Support FROM measured
UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), n FROM overall
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6),
                 CAST(sum(s) AS BIGINT) FROM measured
UNION ALL SELECT 'weighted avg', round(sum(pr * s) / sum(s), 6),
                 round(sum(re * s) / sum(s), 6), round(sum(f1 * s) / sum(s), 6),
                 CAST(sum(s) AS BIGINT) FROM measured""",
}


def _grid(measure: str, step: int) -> str:
    return f"""{_WITH}
SELECT floor({measure} / {step}) * {step} AS {measure}_From,
       floor(Average / 5) * 5 AS Average_From, count(*) AS Students,
       ((2 * sum(CAST(round(Average * 100) AS BIGINT)) + count(*)) // (2 * count(*)))::BIGINT / 100
         AS Mean_Average
FROM scored GROUP BY ALL"""


# Other ways to the same rows.
ORACLE |= {
    "scan_csv": ORACLE["scan_base"],
    "append_committed": ORACLE["append_new"],
    "append_streamed": ORACLE["append_new"],
    "existing_keys_sorted": ORACLE["existing_keys"],
    "find_by_id_sorted": ORACLE["find_by_id"],
    "search_regex_indexed": ORACLE["search_regex"],
    "search_literal_indexed": ORACLE["search_literal"],
    "rel_attendance_grid": _grid("Attendance", 5),
    "rel_study_hours_grid": _grid("Study_Hours", 1),
    "subject_box_approx": f"""{_WITH}, {_LONG_MARKS}
SELECT Subject, count(Mark) AS Marks, true AS Q1_Within, true AS Median_Within, true AS Q3_Within
FROM long_marks GROUP BY Subject""",
    "class_weights": f"""{_WITH}
SELECT Support_Category, count(*) AS Students,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS Weight
FROM scored WHERE mean IS NOT NULL GROUP BY Support_Category""",
    # Without marks in one subject no row is fit to be stored, so keys are refused
    # only where they are stored already.
    "validate_without_marks": f"""WITH {_VERDICTS}
SELECT Student_ID, Name, Gender, Attendance, Study_Hours, CAST(NULL AS DOUBLE) AS Math, Science,
       English, Ingest_Order,
       coalesce(key_fault,
                CASE WHEN Student_ID IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
                     THEN 'Student ID already exists!' END,
                'Please enter valid numeric values.') AS Reject_Reason
FROM judged""",
}
