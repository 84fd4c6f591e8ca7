"""DuckDB twins of the identity jobs, written from the semantics of SURVEY 7.5
with groupings and joins.  Each function returns CTE bodies; ``t`` is a suffix that keeps CTE names unique per day."""

from __future__ import annotations

import datetime as dt

IDEV = """
idev AS (
  SELECT event_id, ts, props, CAST(ts AS DATE) AS event_date,
    epoch_us(ts) AS event_timestamp,
    event_type AS event_name,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'u' || CAST(user_id AS VARCHAR)
         WHEN event_type = 'error' THEN 'undefined' ELSE '' END AS user_id,
    CASE WHEN event_id % 97 = 0 THEN 'undefined'
         ELSE 'c' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 3 AS VARCHAR) END AS user_pseudo_id,
    CASE WHEN event_id % 11 = 0 THEN ''
         WHEN k = 7 THEN 'fh' || CAST(user_id // 2 AS VARCHAR)
         ELSE 'f' || CAST(user_id AS VARCHAR) || '_' || CAST(k % 3 AS VARCHAR) END AS fingerprint
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

EMPTY_MASTER = """
m0 AS (SELECT CAST(NULL AS BIGINT) AS super_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS value,
              CAST(NULL AS TIMESTAMP) AS date_insert, CAST(NULL AS BIGINT) AS date_table WHERE false)"""


def _d(day: dt.date) -> str:
    return f"DATE '{day.isoformat()}'"


def clicks(t: str, start: dt.date | None, end: dt.date | None, where: str = "") -> str:
    if start is not None:
        where = f"WHERE event_date BETWEEN {_d(start)} AND {_d(end)}"
    return f"""
clicks_{t} AS (
  SELECT event_timestamp, event_name, user_id, user_pseudo_id, fingerprint
  FROM (SELECT * FROM idev {where}) WHERE len(json_keys(props)) > 0 GROUP BY ALL)"""


def app(t: str) -> str:
    return f"""
app_{t} AS (
  SELECT nullif(fingerprint, '') AS fgp, if(user_id = 'undefined', '', user_id) AS user_id,
         user_pseudo_id AS client_id, event_timestamp AS date_table
  FROM clicks_{t} WHERE user_pseudo_id <> 'undefined')"""


def labelled(t: str, as_of: str) -> str:
    """A person of the day is (kind, key): kind 0 a known user by user id, kind 1
    anonymous clients by the greatest fingerprint of the client.  A person's id is
    one more than the rows of all persons before; clients of kind 2 (no
    fingerprint) follow, one id each."""
    return f"""
who_{t} AS (
  SELECT client_id, date_table, CASE fgp WHEN 'undefined' THEN '' ELSE fgp END AS print,
         CASE WHEN coalesce(user_id, '') NOT IN ('', 'undefined') THEN user_id END AS known
  FROM app_{t}),
best_{t} AS (SELECT client_id, max(print) AS best FROM who_{t} WHERE known IS NULL GROUP BY client_id),
person_{t} AS (
  SELECT w.*, CASE WHEN known IS NOT NULL THEN 0 WHEN coalesce(print, '') <> '' THEN 1 ELSE 2 END AS kind,
         coalesce(known, best) AS key
  FROM who_{t} w LEFT JOIN best_{t} USING (client_id)),
cell_{t} AS (
  SELECT DISTINCT kind, key, c.name, c.value, date_table
  FROM person_{t}, unnest([{{'name': 'user_id', 'value': known}}, {{'name': 'client_id', 'value': client_id}},
                           {{'name': 'fingerprint', 'value': print}}]) AS u(c)
  WHERE kind < 2 AND c.value <> ''),
size_{t} AS (SELECT kind, key, count(*) AS n FROM cell_{t} GROUP BY kind, key),
number_{t} AS (
  SELECT kind, key, CAST(1 + sum(n) OVER (ORDER BY kind, key) - n AS BIGINT) AS super_id FROM size_{t}),
alone_{t} AS (
  SELECT client_id AS value, date_table, row_number() OVER (ORDER BY client_id, date_table) AS place
  FROM (SELECT DISTINCT client_id, date_table FROM person_{t} WHERE kind = 2)),
lab_{t} AS (
  SELECT super_id, 1 - kind AS user_id_flg, name, value, TIMESTAMP '{as_of}' AS date_insert, date_table
  FROM cell_{t} JOIN number_{t} USING (kind, key)
  UNION ALL
  SELECT place + (SELECT max(super_id) FROM number_{t}), 0, 'client_id', value, TIMESTAMP '{as_of}', date_table
  FROM alone_{t})"""


def last_day(t: str) -> str:
    """Two hops of the smallest id: over the values, and over the ids of a value."""
    return f"""
low_{t} AS (SELECT value, min(super_id) AS low FROM lab_{t} GROUP BY value),
hop_{t} AS (SELECT super_id, min(low) AS hop FROM lab_{t} JOIN low_{t} USING (value) GROUP BY super_id),
home_{t} AS (SELECT value, min(hop) AS super_id FROM lab_{t} LEFT JOIN hop_{t} USING (super_id) GROUP BY value),
early_{t} AS (SELECT name, value, date_insert, min(date_table) AS date_table FROM lab_{t} GROUP BY ALL),
ld_{t} AS (
  SELECT home_{t}.super_id, name, value, date_insert, date_table FROM early_{t} JOIN home_{t} USING (value))"""


def fold(t: str, day_cte: str, master_cte: str, as_of: str) -> str:
    """Rows the day adds, from the state of each of its persons: rows in all, rows
    whose value the master knows, and the smallest id it knows them by."""
    return f"""
match_{t} AS (
  SELECT DISTINCT d.super_id AS person, d.name, d.value, d.date_table, m.name AS old_name, m.value AS old_value,
         m.super_id AS old_id
  FROM {day_cte} d LEFT JOIN {master_cte} m ON m.value = d.value),
state_{t} AS (
  SELECT person, count(*) AS n, count(old_value) AS known, min(old_id) AS old_id FROM match_{t} GROUP BY person),
fresh_{t} AS (
  SELECT person, CAST(sum(n) OVER (ORDER BY person) - n + 1
                      + (SELECT coalesce(max(super_id), 1) FROM {master_cte}) AS BIGINT) AS new_id
  FROM state_{t} WHERE known = 0),
goal_{t} AS (
  SELECT person, coalesce(new_id, old_id) AS super_id
  FROM state_{t} LEFT JOIN fresh_{t} USING (person) WHERE known < n),
ap_{t} AS (
  SELECT super_id, name, value, TIMESTAMP '{as_of}' AS date_insert, date_table
  FROM match_{t} JOIN goal_{t} USING (person))"""


def day_chain(t: str, day: dt.date | None, as_of: str, where: str = "") -> list[str]:
    return [clicks(t, day, day, where), app(t), labelled(t, as_of), last_day(t)]


def session_rank(master_cte: str) -> str:
    """Every value once with its smallest id and times; a row belongs to the last
    user of its person at or before it (by time, then value)."""
    return f"""
once AS (
  SELECT value, min(super_id) AS super_id, min(date_insert) AS date_insert, min(date_table) AS date_table
  FROM {master_cte} GROUP BY value),
named AS (SELECT DISTINCT m.name, once.* FROM {master_cte} m JOIN once USING (value)),
turns AS (
  SELECT super_id, date_table, row_number() OVER (PARTITION BY super_id ORDER BY date_table) AS turn
  FROM (SELECT DISTINCT super_id, date_table FROM named WHERE name = 'user_id')),
users AS (
  SELECT super_id, {{'at': date_table, 'who': value, 'turn': turn}} AS u
  FROM named JOIN turns USING (super_id, date_table) WHERE name = 'user_id'),
owned AS (
  SELECT n.super_id, n.name, n.value, n.date_insert, n.date_table, max(u) AS last_user
  FROM named n LEFT JOIN users ON users.super_id = n.super_id
    AND (u.at < n.date_table OR (u.at = n.date_table AND u.who <= n.value))
  GROUP BY ALL),
visit AS (
  SELECT super_id, who, row_number() OVER (ORDER BY super_id, who NULLS FIRST) AS user_id_rank
  FROM (SELECT DISTINCT super_id, last_user.who AS who FROM owned)),
sr5 AS (
  SELECT o.super_id, o.name, o.value, o.date_insert, o.date_table, coalesce(last_user.turn, 1) AS rank_of_super_id,
         user_id_rank
  FROM owned o JOIN visit v ON v.super_id = o.super_id AND v.who IS NOT DISTINCT FROM o.last_user.who)"""


def closure(t: str) -> str:
    return f"""
edges_{t} AS (SELECT DISTINCT super_id, value FROM lab_{t} WHERE super_id IS NOT NULL AND value IS NOT NULL),
reach_{t}(s, lbl) AS (
  SELECT super_id, super_id FROM edges_{t}
  UNION
  SELECT e2.super_id, r.lbl FROM reach_{t} r
  JOIN edges_{t} e1 ON e1.super_id = r.s JOIN edges_{t} e2 ON e2.value = e1.value
  WHERE r.lbl < e2.super_id),
comp_{t} AS (
  SELECT e.value, min(l.lbl) AS super_id
  FROM edges_{t} e JOIN (SELECT s, min(lbl) AS lbl FROM reach_{t} GROUP BY s) l ON l.s = e.super_id
  GROUP BY e.value)"""
