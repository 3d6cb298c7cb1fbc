"""DuckDB statements that give the same rows as the registered queries, by plain SQL."""

from __future__ import annotations

EXACT_DEDUP = """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# One more backslash inside "<", backslashes, "|"; in roles backslash and line feed are escaped before.
_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
_ROLE = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
CHAT = rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
        FROM (VALUES (0, 'user'), (1, 'assistant')) AS more(turn, role)
    ), pieces AS (
        SELECT *, '<|im_start|>' || {_ESCAPED.format(_ROLE)} || chr(10)
            || {_ESCAPED.format("text")} || '<|im_end|>' || chr(10) AS piece
        FROM turns
    )
    SELECT conv_id,
           count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(length(piece))::BIGINT AS formatted_chars
    FROM pieces
    GROUP BY conv_id
"""

# Texts are hex digits, two per byte; a window of 50 bytes is 100 digits.
REPEATS = """
    WITH texts AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
    ), windows AS (
        SELECT doc_id, pos, substr(digits, 2 * pos + 1, 100) AS part
        FROM (SELECT *, unnest(range(0, length(digits) // 2 - 49)) AS pos FROM texts)
    ), starts AS (
        SELECT doc_id, pos
        FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY part) AS first FROM windows)
        WHERE first < doc_id
    ), runs AS (
        SELECT doc_id, min(pos) AS low, max(pos) + 50 AS high
        FROM (
            SELECT doc_id, pos, sum(apart) OVER (PARTITION BY doc_id ORDER BY pos) AS run
            FROM (
                SELECT *, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 THEN 0 ELSE 1 END AS apart
                FROM starts
            )
        )
        GROUP BY doc_id, run
    ), between_runs AS (
        SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM runs
        UNION ALL
        SELECT doc_id, max(high), NULL FROM runs GROUP BY doc_id
    ), left_over AS (
        SELECT doc_id, string_agg(
            CASE WHEN high IS NULL THEN substr(digits, 2 * low + 1) ELSE substr(digits, 2 * low + 1, 2 * (high - low)) END,
            '' ORDER BY low) AS digits
        FROM between_runs JOIN texts USING (doc_id)
        GROUP BY doc_id
    ), counted AS (
        SELECT doc_id, count(*) AS n_spans, sum(high - low)::BIGINT AS n_removed FROM runs GROUP BY doc_id
    )
    SELECT doc_id,
           length(texts.digits) // 2 AS n_bytes,
           coalesce(n_removed, 0) AS n_removed,
           coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(left_over.digits, texts.digits))) AS kept_sha256
    FROM texts LEFT JOIN left_over USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

_CELL = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"


def _edit(cell: str, letter: str, cost: str, line: str = "NULL") -> str:
    """A cell (cost, audit, repaired rows, each after a line feed) with one more edit."""
    text = f"{cell}.t" if line == "NULL" else f"{cell}.t || chr(10) || {line}"
    return (
        f"CASE WHEN {cell} IS NOT NULL THEN {{'c': ({cell}.c + {cost})::BIGINT, "
        f"'a': {cell}.a || '{letter}', 't': {text}}} END"
    )


def _least(*cells: str) -> str:
    """The cheapest cell, of equals the one whose edits come first; NULL cells do not count."""
    return f"list_min([{', '.join(cells)}])"


def _allowed(condition: str, cell: str) -> str:
    return f"CASE WHEN {condition} THEN {cell} END"


def _inserted(source: str) -> str:
    """``source`` with cells i0 to i3: after rows put in before the next one."""
    user = _least("s2", *[_edit(cell, "I", "5", "'user:'") for cell in ("s0", "s1", "s3")])
    assistant = _least("s3", _edit("i2", "I", "5", "'assistant:'"))
    return f"SELECT *, {assistant} AS i3 FROM (SELECT *, s0 AS i0, s1 AS i1, {user} AS i2 FROM {source})"


def _row_cells() -> list[str]:
    keep, rerole = "more", "1 + more"

    def after(starts: tuple[str, ...], initial: str, role: str) -> list[str]:
        kept = [_allowed(f"NOT bad AND role[1] = '{initial}'", _edit(s, "K", keep, "(role || ':' || text)")) for s in starts]
        changed = [_allowed("NOT bad", _edit(s, "R", rerole, f"('{role}:' || text)")) for s in starts if role]
        return kept + changed

    return [
        _edit("i0", "D", "2"),
        _least(_edit("i1", "D", "2"), *after(("i0",), "s", "")),
        _least(_edit("i2", "D", "2"), *after(("i0", "i1", "i3"), "u", "user")),
        _least(_edit("i3", "D", "2"), *after(("i2",), "a", "assistant")),
    ]


_NULLS = ", ".join(f"NULL::{_CELL} AS s{i}" for i in (1, 2, 3))
REPAIR = rf"""
    WITH RECURSIVE crc_table AS (
        SELECT list(c ORDER BY i) AS entries
        FROM (
            SELECT i, list_reduce(list_concat([i], range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM range(256) AS r(i)
        )
    ), keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
        FROM conversations
    ), kinds AS (
        SELECT keyed.*, xor(4294967295, list_reduce(
            list_concat([4294967295], list_transform(range(1, length(key) + 1), lambda p: ascii(substr(key, p, 1))::BIGINT)),
            lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) % 20 AS kind
        FROM keyed, crc_table
    ), damaged AS (
        SELECT conv_id, turn,
            CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds
    ), placed AS (
        SELECT *,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
            NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS empty
        FROM damaged
    ), faults AS (
        SELECT *,
            CASE WHEN empty THEN 'blank' WHEN again THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault,
            lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed)
    ), counts AS (
        SELECT conv_id,
            count(i) AS n,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (WHERE fault = 'blank') AS blank,
            count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
            count(*) FILTER (WHERE fault = 'truncated') AS truncated,
            count(*) FILTER (WHERE i > 1 AND before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
        FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN faults USING (conv_id)
        GROUP BY conv_id
    ), program AS (
        SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}}::{_CELL} AS s0, {_NULLS} FROM counts
        UNION ALL
        SELECT conv_id, i, {", ".join(_row_cells())}
        FROM (
            SELECT here.* EXCLUDE (i), rows.i, rows.role, rows.text,
                coalesce(fault IN ('blank', 'duplicate'), false) AS bad,
                CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
            FROM ({_inserted("program")}) AS here
            JOIN faults AS rows ON rows.conv_id = here.conv_id AND rows.i = here.i + 1
        )
    ), ended AS (
        SELECT conv_id, {_least("i0", "i3")} AS best
        FROM ({_inserted("(SELECT program.* FROM program JOIN counts ON program.conv_id = counts.conv_id AND i = n)")})
    )
    SELECT conv_id, gaps, blank, duplicate, truncated, illegal,
        best.c AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
    FROM counts JOIN ended USING (conv_id)
"""

SEARCH = r"""
    WITH cut AS (
        SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), sizes AS (
        SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM cut WHERE len(terms) > 0
    ), items AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), words AS (
        SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM cut
    ), postings AS (
        SELECT doc, doc_id, n, term, count(*) AS tf
        FROM words WHERE term IN (SELECT term FROM items) GROUP BY ALL
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM postings, sizes GROUP BY term
    ), scores AS (
        SELECT item_id, doc, doc_id, sum(w * ((1000000000 * tf)
            // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM items JOIN postings USING (term) JOIN weights USING (term), sizes
        GROUP BY item_id, doc, doc_id
    ), ranked AS (
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank,
            doc_id, score
        FROM scores WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
