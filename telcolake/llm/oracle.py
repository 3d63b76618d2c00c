"""Expected results in the SQL of another engine, written from the contracts alone."""

from __future__ import annotations

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _merkle(leaf_levels: int = 12, group_levels: int = 8) -> str:
    """Three children per node, one tree per source and one over the sources; up to 3^12 rows and 3^8 sources."""

    def leaf(text: str) -> str:
        parts = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({p})::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"

    crc = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))"""
    parts = [
        f"""hashed AS MATERIALIZED (
            SELECT doc_id, source, {leaf("text")} AS leaf,
                CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS tampered
            FROM documents)""",
        """l0 AS MATERIALIZED (
            SELECT *, coalesce('s' || source, '-') AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                leaf AS h, tampered AS f, '' AS sibs
            FROM hashed)""",
    ]

    def climb(prefix: str, levels: int) -> None:
        for k in range(levels):
            parts.append(f"""{prefix}r{k} AS MATERIALIZED (
                SELECT grp, i // 3 AS run, list(h ORDER BY i) AS hs, max(count(*)) OVER (PARTITION BY grp) AS most, count(*) OVER (PARTITION BY grp) AS runs
                FROM (SELECT DISTINCT grp, i, h FROM {prefix}{k}) GROUP BY grp, i // 3)""")
            slot, ends = "(i % 3 + 1)::BIGINT", "most = 1 AND runs = 1"
            left, right = f"array_to_string(hs[1:{slot} - 1], '')", f"array_to_string(hs[{slot} + 1:3], '')"
            parts.append(f"""{prefix}{k + 1} AS MATERIALIZED (
                SELECT n.* REPLACE (i // 3 AS i, CASE WHEN {ends} THEN h ELSE sha256(array_to_string(hs, '')) END AS h,
                    CASE WHEN {ends} THEN f ELSE sha256({left} || f || {right}) END AS f,
                    CASE WHEN {ends} THEN sibs ELSE sibs || {left} || {right} END AS sibs)
                FROM {prefix}{k} n JOIN {prefix}r{k} r ON n.grp = r.grp AND n.i // 3 = r.run)""")

    climb("l", leaf_levels)
    parts.append(f"""g0 AS MATERIALIZED (
        SELECT * REPLACE ('all' AS grp, dense_rank() OVER (ORDER BY grp) - 1 AS i), h AS subroot FROM l{leaf_levels})""")
    climb("g", group_levels)
    return "WITH " + ", ".join(parts) + f""" SELECT doc_id, leaf, subroot, h AS root, sha256(sibs) AS proof_sha256, f AS folded_root, f = h AS verified
        FROM g{group_levels}"""


_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SQL = {
    "op5_line_bitmaps": f"""
        WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut),
        keyed AS (SELECT *, {_lower(f"trim(line, {_WHITE})")} AS key FROM lines),
        repeated AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
            SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone
            FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op2_warc_transactions": """
        WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
        coded AS (
            SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, h,
                list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                    (('0x' || substr(h, 1 + 5 * (i // 4)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::BIGINT, 1)),
                    'string_agg', '') AS payload_digest
            FROM hashed),
        firsts AS (SELECT h, min(page_id) AS first FROM hashed GROUP BY h)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM coded JOIN firsts USING (h)""",
    "op3_positional_index": f"""
        WITH dw AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
        iw AS (SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORD}) AS w FROM benchmark),
        wins AS (
            SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS size
            FROM iw, range(1, greatest(len(w) - 9, 1) + 1) r(i) WHERE len(w) > 0),
        runs AS (
            SELECT doc_id, i AS start, size, array_to_string(w[i:i + size - 1], ' ') AS win
            FROM dw, (SELECT DISTINCT size FROM wins) s, range(1, len(w) - size + 2) r(i) WHERE len(w) >= size),
        met AS (SELECT DISTINCT doc_id, start, r.size, item_id FROM runs r JOIN wins USING (win, size)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM met, range(start, start + size) t(p) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS h
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id)
        SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
            coalesce(named.n, 0)::BIGINT AS n_items, coalesce(h, sha256('')) AS items_sha256,
            coalesce(hit.n, 0) > 0 AS contaminated
        FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN named ON dw.doc_id = named.doc_id""",
    "op11_merkle_windows": _merkle(),
}
