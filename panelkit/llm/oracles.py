"""SQL that says the same as the queries of conversation repair and of spelling variants."""

from __future__ import annotations

# Checksums of texts: the table of the usual reflected polynomial, then byte by byte.
_CRC_TABLE = """crc_bits AS (
      SELECT n, n AS c, 0 AS k FROM (SELECT unnest(range(256)) AS n)
      UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
      FROM crc_bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY n) AS t FROM crc_bits WHERE k = 8)"""


def _crc32(text: str) -> str:
    """SQL for the checksum of a text, with the table ``t`` at hand."""
    code = f"list_transform(range(octet_length(encode({text}))), lambda i: "
    code += f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    step = "xor(a >> 8, t[(xor(a, b) & 255) + 1])"
    first = "list_prepend(CAST(4294967295 AS BIGINT), "
    return f"xor(list_reduce({first}{code}), lambda a, b: {step}), 4294967295)"


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

CONVERSATION_REPAIR = f"""
    WITH RECURSIVE {_CRC_TABLE},
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
      FROM conversations),
    kinds AS (SELECT *, {_crc32("k")} % 20 AS kind FROM keyed CROSS JOIN crc),
    turns AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
    placed AS (SELECT *, left(role, 1) AS initial, right(rtrim(text, {_BLANKS}), 1) AS ending,
        row_number() OVER (PARTITION BY conv_id
          ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
      FROM turns),
    judged AS (SELECT *, ending = '' AS blank, ending <> '' AND nth > 1 AS again,
        ending <> '' AND nth = 1 AND ending NOT IN ('.', '!', '?') AS cut,
        coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial
          NOT IN ('su', 'ua', 'au'), false) AS wrong FROM placed),
    faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
        count(*) FILTER (cut) AS truncated, count(*) FILTER (wrong) AS illegal, max(i) AS n
      FROM judged GROUP BY conv_id),
    steps(q, r, after, name) AS (VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'),
      (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
    puts(q, after, cost, audit, put) AS (
      SELECT unnest(range(4)), unnest(range(4)), 0, '', ''
      UNION ALL SELECT q, after, 3, 'I', chr(10) || name || ':' FROM steps WHERE name IS NOT NULL
      UNION ALL SELECT a.q, b.after, 6, 'II', chr(10) || a.name || ':' || chr(10) || b.name || ':'
      FROM steps a JOIN steps b ON a.after = b.q WHERE a.name IS NOT NULL),
    best AS (
      SELECT f.conv_id, CAST(0 AS BIGINT) AS i, p.after AS q, p.cost, p.audit, p.put AS out
      FROM faults f JOIN puts p ON p.q = 0
      UNION ALL
      (WITH moved AS (
        SELECT b.conv_id, j.i, b.q, b.cost + 4 AS cost, b.audit || 'D' AS audit, b.out
        FROM best b JOIN judged j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = b.i + 1
        UNION ALL
        SELECT b.conv_id, j.i, s.after,
          b.cost + CASE WHEN j.cut THEN 3 ELSE 0 END + CASE WHEN s.r = j.initial THEN 0 ELSE 3 END,
          b.audit || CASE WHEN s.r = j.initial THEN 'K' ELSE 'R' END,
          b.out || chr(10) || CASE WHEN s.r = j.initial THEN j.role ELSE s.name END || ':' || j.text
        FROM best b JOIN judged j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = b.i + 1
        JOIN steps s ON s.q = b.q AND (s.r = j.initial OR s.name IS NOT NULL)
        WHERE NOT j.blank AND NOT j.again)
      SELECT m.conv_id, m.i, p.after, m.cost + p.cost, m.audit || p.audit, m.out || p.put
      FROM moved m JOIN puts p ON p.q = m.q
      QUALIFY row_number() OVER (PARTITION BY m.conv_id, m.i, p.after
        ORDER BY m.cost + p.cost, m.audit || p.audit) = 1)),
    ended AS (SELECT b.* FROM best b JOIN faults f
        ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.i = f.n WHERE b.q IN (0, 3)
      QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost, b.audit) = 1)
    SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank,
      coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
      coalesce(f.illegal, 0) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost,
      coalesce(e.audit, '') AS audit, sha256(substr(coalesce(e.out, ''), 2)) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN faults f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
    LEFT JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""

SPELLING_VARIANTS = f"""
    WITH RECURSIVE {_CRC_TABLE},
    runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run
      FROM documents),
    lowered AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL),
    checked AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k FROM lowered
      WHERE length(run) >= 5),
    hashed AS (SELECT run, n, {_crc32("k")} AS h FROM checked CROSS JOIN crc),
    spelt AS (SELECT n, CASE WHEN h % 97 = 0
        THEN left(run, h % length(run)) || substr(run, CAST(h % length(run) + 2 AS BIGINT))
        ELSE run END AS word FROM hashed),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5
      GROUP BY word HAVING sum(n) >= 3),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    shorter AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
    replaced AS (SELECT a.word, b.word AS near, b.n FROM shorter a JOIN shorter b
      ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
    lost AS (SELECT DISTINCT s.word AS long, s.n AS long_n, w.word AS short, w.n AS short_n
      FROM shorter s JOIN words w ON s.rest = w.word),
    near AS (SELECT * FROM replaced UNION ALL SELECT long, short, short_n FROM lost
      UNION ALL SELECT short, long, long_n FROM lost),
    found AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
    firsts AS (SELECT word, near, n FROM near
      QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, near) = 1),
    formed AS (SELECT w.word, w.n, coalesce(f.n_near, 0) AS n_near,
        CASE WHEN b.n >= 2 * w.n THEN b.near END AS form,
        CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
      FROM words w LEFT JOIN found f ON f.word = w.word LEFT JOIN firsts b ON b.word = w.word),
    chain AS (SELECT word, word AS at FROM formed
      UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at
      WHERE f.form IS NOT NULL),
    last AS (SELECT c.word, c.at AS root FROM chain c JOIN formed f ON f.word = c.at
      WHERE f.form IS NULL)
    SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM formed f JOIN last l ON l.word = f.word"""
