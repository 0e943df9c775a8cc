"""Derived CRM-shaped inputs (FIXTURES.md section 2).

Each text runs unchanged in Spark SQL and DuckDB, so the Spark views and
the oracle CTEs start from the same rows.  All of them read the driver
tables, so their size grows with the scale factor.
"""

from __future__ import annotations

FIXTURE_SQL = {
    "wifi_guests": """
SELECT 'doc-' || CAST(c_custkey AS STRING) AS doc_id,
  CASE WHEN c_custkey % 11 = 0 THEN split_part('Unknown,n/a,-,guest,test', ',', CAST(c_custkey % 5 AS INT) + 1)
       ELSE ' ' || split_part('Ana,Omar,Lea,Sam,Noor,Ivy,Raj', ',', CAST(c_custkey % 7 AS INT) + 1) || ' ' END AS fname,
  CASE WHEN c_custkey % 13 = 0 THEN NULL
       ELSE split_part('Haddad,Khan,Smith,Nasser,Lopez', ',', CAST(c_custkey % 5 AS INT) + 1) END AS lname,
  CASE WHEN c_custkey % 29 = 0 THEN NULL
       WHEN c_custkey % 31 = 0 THEN CAST(900000 + c_custkey AS STRING) || '@gmail.com'
       WHEN c_custkey % 37 = 0 THEN 'staff' || CAST(c_custkey AS STRING) || '@yolkbrands.com'
       WHEN c_custkey % 41 = 0 THEN 'broken' || CAST(c_custkey AS STRING) || '.example.com'
       ELSE CASE WHEN c_custkey % 4 = 0 THEN ' User.' ELSE 'user' END || CAST(CASE WHEN c_custkey % 20 IN (12, 16) THEN c_custkey - 6 WHEN c_custkey % 30 = 24 THEN c_custkey - 12 ELSE c_custkey END AS STRING)
            || CASE WHEN c_custkey % 8 = 0 THEN '+promo' ELSE '' END || '@'
            || split_part('gmail.com,googlemail.com,gmial.com,hotmail.com,yahoo.con,example.com', ',', CAST(c_custkey % 6 AS INT) + 1)
  END AS email,
  CASE WHEN c_custkey % 17 = 0 THEN 'not-a-date'
       WHEN c_custkey % 19 = 0 THEN '1890-01-01'
       WHEN c_custkey % 23 = 0 THEN CAST(2008 + c_custkey % 9 AS STRING) || '-06-15'
       WHEN c_custkey % 43 = 0 THEN '2031-01-01'
       WHEN c_custkey % 3 = 0 THEN NULL
       ELSE CAST(1950 + c_custkey % 55 AS STRING) || '-' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0')
            || '-' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || 'T00:00:00' END AS dob,
  CASE WHEN c_nationkey % 9 = 8 THEN NULL
       WHEN c_nationkey = 0 THEN 'pickl'
       ELSE split_part('pickl,bonbird,southpour', ',', CAST(c_nationkey % 3 AS INT) + 1) || '-'
            || split_part('united-arab-emirates-jbr,united-arab-emirates-city-walk?cmd=login,jordan-vista-4,saudi-arabia-,jordan,egypt-cairo-mall,oman-muscat--,qatar', ',', CAST(c_nationkey % 8 AS INT) + 1)
  END AS lastmarket,
  TIMESTAMP '2024-01-15 00:00:00' AS updated_at
FROM customer
""",
    "revel_raw": """
SELECT o_orderkey AS _seq,
  '/resources/Customer/' || CAST(o_custkey * 3 + o_orderkey % 3 AS STRING) || '/' AS resource_uri,
  split_part('Pickl,Bonbird,Southpour', ',', CAST(o_orderkey % 3 AS INT) + 1) AS _brand,
  CASE WHEN o_custkey % 10 = 0 THEN 'GUEST'
       ELSE split_part('Ana,Omar,Lea,Sam,Noor,Ivy,Raj', ',', CAST(o_custkey % 7 AS INT) + 1) END AS first_name,
  CASE WHEN o_custkey % 8 = 0 THEN NULL
       ELSE split_part('Haddad,Khan,Smith,Nasser,Lopez', ',', CAST(o_custkey % 5 AS INT) + 1) END AS last_name,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL
       WHEN o_orderkey % 20 = 1 THEN 'test@test.com'
       WHEN o_orderkey % 20 = 2 THEN 'p' || CAST(o_custkey AS STRING) || '@mailinator.com'
       WHEN o_orderkey % 20 = 3 THEN 'x' || CAST(o_custkey AS STRING) || '@grubtech.com'
       WHEN o_orderkey % 20 = 4 THEN split_part('sdfgsdfgsdfg,qwrtplkjh,aaaaaaaa,xyzxyzxyz,hjklhjkl', ',', CAST(o_custkey % 5 AS INT) + 1) || '@gmail.com'
       WHEN o_orderkey % 20 = 5 THEN 'no-at-sign'
       WHEN o_orderkey % 20 = 6 THEN '   '
       WHEN o_orderkey % 20 = 7 THEN chr(160) || 'User' || CAST(o_custkey AS STRING) || '@hotmail.com'
       WHEN o_orderkey % 20 = 8 THEN 'us' || chr(160) || 'er' || CAST(o_custkey AS STRING) || '@hotmail.com'
       ELSE ' User' || CAST(o_custkey AS STRING) || '@'
            || split_part('gmail.com,hotmail.com,example.com', ',', CAST(o_custkey % 3 AS INT) + 1) END AS email,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL
       ELSE o_orderpriority IN ('1-URGENT', '2-HIGH') END AS email_opt_in,
  CASE WHEN o_orderkey % 50 = 0 THEN 'bad-date' ELSE CAST(o_orderdate AS STRING) END AS updated_date
FROM orders
""",
    "signup_events": """
SELECT event_id, ts,
  CASE WHEN event_id % 40 = 0 THEN 'no-at-sign' WHEN event_id % 41 = 0 THEN NULL
       ELSE ' User' || CAST(user_id AS STRING) || '@'
            || split_part('gmail.com,hotmail.com,example.com', ',', CAST(user_id % 3 AS INT) + 1) END AS email,
  split_part('pickl,EatPickl ,bonbird,southpour,elsewhere', ',', CAST(event_id % 5 AS INT) + 1) AS site,
  CASE WHEN event_id % 15 = 4 THEN 'bonbird' END AS brand,
  CASE WHEN event_id % 9 = 0 THEN 'jordan' END AS country,
  CASE WHEN event_id % 4 = 0 THEN 'Ana' WHEN event_id % 4 = 1 THEN ' ' END AS first_name,
  CASE WHEN event_id % 6 = 0 THEN 'Khan' END AS last_name,
  '/p' || CAST(event_id % 4 AS STRING) AS page
FROM events WHERE event_type = 'signup'
""",
    "prior_master": """
SELECT 'user' || CAST(s_suppkey AS STRING) || '@' || split_part('gmail.com,hotmail.com,example.com', ',', CAST(s_suppkey % 3 AS INT) + 1) AS email,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Prior' END AS first_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Record' END AS last_name,
  CASE WHEN s_suppkey % 4 = 0 THEN 'Jordanian' END AS nationality,
  CASE WHEN s_suppkey % 10 = 0 THEN DATE '2010-05-05' WHEN s_suppkey % 5 = 0 THEN DATE '1980-02-29' END AS birthday,
  CASE WHEN s_suppkey % 2 = 0 THEN split('REVEL,UAE,PICKL', ',') ELSE split('WIFI,BONBIRD,JORDAN,VISTA-4', ',') END AS tags,
  CASE WHEN s_suppkey % 7 = 0 THEN false WHEN s_suppkey % 7 = 1 THEN NULL ELSE true END AS allow_email,
  CASE WHEN s_suppkey % 2 = 0 THEN split('revel_customers', ',') ELSE split('wifi_guests', ',') END AS sources,
  s_suppkey % 6 = 0 AS needs_push
FROM supplier
""",
    "push_state": """
SELECT email, brand, status,
  CASE WHEN status IN ('failed', 'conflict') THEN 'rejected by platform' ELSE 'created' END AS detail,
  CASE WHEN status = 'ok' THEN 'm' || CAST(k AS STRING) END AS como_member_id,
  CAST(NULL AS STRING) AS common_ext_id,
  TIMESTAMP '2024-01-20 00:00:00' - INTERVAL '1' DAY * CAST(k % 30 AS INT) AS last_pushed_at
FROM (
  SELECT c_custkey AS k,
    'user' || CAST(c_custkey AS STRING) || '@' || split_part('gmail.com,hotmail.com,example.com', ',', CAST(c_custkey % 3 AS INT) + 1) AS email,
    split_part('PICKL,BONBIRD,SOUTHPOUR', ',', CAST(c_custkey % 3 AS INT) + 1) AS brand,
    split_part('ok,exists,failed,conflict,failed', ',', CAST(c_custkey % 5 AS INT) + 1) AS status
  FROM customer) q
""",
    "push_responses": """
SELECT email, brand, mode, attempt, lookup_body, create_body, update_body,
  CASE WHEN create_body IS NULL AND update_body IS NULL THEN 'HTTPSConnectionPool(host=''api''): "timed out" é' END AS error_text
FROM (
  SELECT 'user' || CAST(c_custkey AS STRING) || '@example.com' AS email,
    split_part('PICKL,BONBIRD,SOUTHPOUR', ',', CAST(c_custkey % 3 AS INT) + 1) AS brand,
    CASE WHEN c_custkey % 2 = 0 THEN 'create' ELSE 'update' END AS mode, 1 AS attempt,
    CASE CAST(c_custkey % 5 AS INT)
      WHEN 0 THEN '{"status":"ok","membership":{"comoMemberId":"m' || CAST(c_custkey AS STRING) || '","commonExtId":"x' || CAST(c_custkey AS STRING) || '"}}'
      WHEN 4 THEN NULL
      WHEN 3 THEN '{"status":"error","errors":[{"code":"5000001"}]}'
      ELSE '{"status":"error","errors":[{"code":"4001012"}]}' END AS lookup_body,
    CASE CAST(c_custkey % 7 AS INT)
      WHEN 0 THEN '{"status":"error","errors":[{"code":"4000","cause":[{"code":4000000}]}]}'
      WHEN 1 THEN NULL
      WHEN 2 THEN '{"status":"error","errors":[{"code":"9999999","message":"retry at 12:30,then [é]"}]}'
      WHEN 3 THEN '{"status":"error","errors":[{"code":"9999998","message":"member already exists"}]}'
      ELSE '{"status":"ok","membership":{"comoMemberId":"n' || CAST(c_custkey AS STRING) || '"}}' END AS create_body,
    CASE CAST(c_custkey % 11 AS INT)
      WHEN 1 THEN '{"status":"error","errors":[{"code":"4001012"}]}'
      WHEN 3 THEN '{"status":"error","errors":[{"code":"4000000"}]}'
      WHEN 5 THEN '{"status":"error","errors":[{"code":"4000000","cause":[{"code":"4001012"}]}]}'
      WHEN 7 THEN '{"status":"error","errors":[{"code":"9999999"}]}'
      WHEN 9 THEN NULL
      ELSE '{"status":"ok"}' END AS update_body
  FROM customer
  UNION ALL
  SELECT 'user' || CAST(c_custkey AS STRING) || '@example.com',
    split_part('PICKL,BONBIRD,SOUTHPOUR', ',', CAST(c_custkey % 3 AS INT) + 1), 'create', 2,
    '{"status":"error","errors":[{"code":"4001012"}]}',
    CASE WHEN c_custkey % 4 = 0 THEN '{"status":"ok","membership":{"comoMemberId":"r' || CAST(c_custkey AS STRING) || '"}}' END, NULL
  FROM customer WHERE c_custkey % 6 < 2) q
""",
    "wifi_batch_1": """
SELECT 'doc-' || CAST(c_custkey AS STRING) AS doc_id, 'F' || CAST(c_custkey % 7 AS STRING) AS "Fname",
  'L' || CAST(c_custkey % 5 AS STRING) AS lname FROM customer WHERE c_custkey % 4 <> 3
""",
    "wifi_batch_2": """
SELECT 'doc-' || CAST(c_custkey AS STRING) AS doc_id, 'G' || CAST(c_custkey % 7 AS STRING) AS fname,
  c_custkey % 12 AS visits, '{"plan": "free"}' AS meta FROM customer WHERE c_custkey % 4 <> 0
""",
    "wifi_json_1": """
SELECT c_custkey AS _seq, 'doc-' || CAST(c_custkey AS STRING) AS doc_id,
  '{"Fname":"F' || CAST(c_custkey % 7 AS STRING) || '","lname":"L' || CAST(c_custkey % 5 AS STRING) || '"}' AS body
FROM customer WHERE c_custkey % 4 <> 3
""",
    "wifi_json_2": """
SELECT c_custkey AS _seq, 'doc-' || CAST(c_custkey AS STRING) AS doc_id,
  '{"visits":' || CAST(c_custkey % 12 AS STRING)
    || CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN ',"Fname":null' ELSE ',"Fname":"G' || CAST(c_custkey % 7 AS STRING) || '"' END
    || CASE WHEN c_custkey % 5 = 0 THEN ',"meta":{"plan":"free","n":[1,2]}' ELSE '' END || '}' AS body
FROM customer WHERE c_custkey % 4 <> 0
UNION ALL
SELECT 1000000000 + c_custkey, 'doc-' || CAST(c_custkey AS STRING),
  CASE WHEN c_custkey % 8 = 1 THEN '{"visits":null}' ELSE '{"lname":"second","visits":99}' END
FROM customer WHERE c_custkey % 4 = 1
""",
    "wifi_typed_1": """
SELECT c_custkey AS _seq, 'doc-' || CAST(c_custkey AS STRING) AS doc_id,
  '{"Visits":' || CAST(c_custkey % 12 AS STRING) || ',"vip":' || CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END
    || ',"spend":' || CAST(c_custkey % 50 AS STRING) || CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN '.25' ELSE '.5' END
    || ',"joined":"2023-0' || CAST(1 + c_custkey % 9 AS STRING) || '-11T0' || CAST(c_custkey % 10 AS STRING) || ':30:00Z"'
    || ',"born":"19' || CAST(50 + c_custkey % 50 AS STRING) || '-06-15"'
    || ',"score":' || CAST(c_custkey % 7 AS STRING) || ',"code":' || CAST(c_custkey % 100 AS STRING)
    || CASE WHEN c_custkey % 5 = 0 THEN ',"meta":{"n":' || CAST(c_custkey % 3 AS STRING) || '}' ELSE '' END
    || ',"empty":null}' AS body
FROM customer WHERE c_custkey % 4 <> 3
""",
    "wifi_typed_2": """
SELECT c_custkey AS _seq, 'doc-' || CAST(c_custkey AS STRING) AS doc_id,
  '{"visits":' || CASE WHEN c_custkey % 6 = 0 THEN 'null' ELSE CAST(100 + c_custkey % 12 AS STRING) END
    || ',"born":"19' || CAST(50 + c_custkey % 50 AS STRING) || CASE WHEN c_custkey % 7 = 0 THEN '-06-15T12:00:00Z"' ELSE '-06-15"' END
    || ',"score":' || CAST(c_custkey % 7 AS STRING) || '.5'
    || CASE WHEN c_custkey % 9 = 0 THEN ',"code":"A' || CAST(c_custkey % 100 AS STRING) || '"' WHEN c_custkey % 9 = 1 THEN ',"Code":7' ELSE '' END
    || ',"big":' || CASE WHEN c_custkey % 10 = 0 THEN '123456789012345678901' ELSE CAST(c_custkey AS STRING) END
    || CASE WHEN c_custkey % 8 = 1 THEN ',"note":"2024-13-45"' WHEN c_custkey % 8 = 2 THEN ',"note":"2024-01-05"' ELSE '' END || '}' AS body
FROM customer WHERE c_custkey % 4 <> 0
""",
    "run_log": """
SELECT 'run' || CAST(event_id AS STRING) AS id,
  split_part('wifi,revel,master,push,push_dry', ',', CAST(event_id % 5 AS INT) + 1) AS job,
  ts AS started_at, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts + INTERVAL '1' MINUTE END AS finished_at,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status
FROM events
""",
}
