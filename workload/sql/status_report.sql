-- Marks per weekday of the pupils with one status; the separator ; in a comment or text is no boundary.
CREATE OR REPLACE TEMPORARY VIEW marked AS
SELECT f.*, d.weekday, ';' AS separator
FROM fact_pupil_attendance_daily f
JOIN dim_date d ON d.date_key = f.date_key;

SELECT weekday, separator, attendance, count(*) AS marks, count(DISTINCT pupil_key) AS pupils
FROM marked
WHERE status = :status
GROUP BY weekday, separator, attendance;
