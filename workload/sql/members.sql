-- New class streams named after the schools, one of them taken back, the others renamed in the copy of the pupils.
INSERT INTO dim_stream SELECT 1000 + academy_key, 'NEW ' || academy_name FROM dim_academy;
DELETE FROM dim_stream WHERE stream LIKE 'NEW A%' AND stream_key IN (SELECT 1000 + academy_key FROM dim_academy);
UPDATE dim_pupil SET last_name = upper(first_name) || :suffix WHERE pupil_id % 3 = 0;
SELECT count(*) AS n FROM dim_stream;
