"""DuckDB SQL of the queries that SQL can express, by plain definitions."""

from __future__ import annotations

from snapdeck.llm.quality import COMMON_WORDS, SIGN_WORDS, WORD_BINS, Limits

_CHATS = """
    WITH turns AS (
        SELECT conv_id, turn, role, text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
               count(*) OVER (PARTITION BY conv_id) AS n_turns,
               list(struct_pack(r := role, t := text)) OVER (
                   PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS so_far
        FROM conversations),
    whole AS (
        SELECT so_far, min(conv_id) AS conv_id, count(*) AS n_copies
        FROM turns WHERE pos = n_turns GROUP BY so_far),
    kept AS (
        SELECT conv_id, n_copies FROM whole
        WHERE so_far NOT IN (SELECT so_far FROM turns WHERE pos < n_turns))
    SELECT conv_id, any_value(n_turns) AS n_turns, any_value(n_copies) AS n_copies,
           dense_rank() OVER (PARTITION BY conv_id ORDER BY block) - 1 AS part,
           string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '')
                      || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text
    FROM (SELECT *, floor(turn / 256.0) AS block FROM turns JOIN kept USING (conv_id))
    GROUP BY conv_id, block
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

_BENCHMARK = f"""
    WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
        FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
              FROM items WHERE len(w) > 0)),
    docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
    grams AS (
        SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
        FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
    met AS (SELECT grams.* FROM grams SEMI JOIN item_windows USING (n, g)),
    hits AS (
        SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM met) GROUP BY rid),
    listed AS (
        SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids
        FROM met JOIN item_windows USING (n, g) WHERE item_id IS NOT NULL GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
           sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (rid) LEFT JOIN listed USING (rid)
"""


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _quality(limits: Limits = Limits()) -> str:
    left_over = lambda cls: f"length(t) - length(regexp_replace(t, '[{cls}]', '', 'g'))"
    classes = ", ".join(
        f"CAST({left_over(c)} AS BIGINT)" for c in ("a-z", r"\x20\x09-\x0D", "A-Z", "0-9", "#*$%&|<>")
    )
    others = left_over(r"\x21\x22\x27-\x29\x2B-\x2F\x3A\x3B\x3D\x3F\x40\x5B-\x60\x7B\x7D\x7E")
    term = "CASE WHEN p[i] > 0 THEN p[i] * log2(2 * p[i] / (p[i] + q[i])) ELSE 0 END"
    mirror = "CASE WHEN q[i] > 0 THEN q[i] * log2(2 * q[i] / (q[i] + p[i])) ELSE 0 END"
    distance = f"sqrt(greatest(0.0, list_sum([({term} + {mirror}) / 2 FOR i IN range(1, len(p) + 1)])))"
    return rf"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
    parts AS (
        SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split_regex(lower(t), '[\x20\x09-\x0D.,;:!?]+'),
                           lambda x: list_contains({_list((*WORD_BINS, *SIGN_WORDS))}, x)) AS common,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
        FROM docs),
    windows AS (
        SELECT rid, i, w[i : i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
    again AS (
        SELECT rid, count(DISTINCT p) AS n FROM (
            SELECT rid, unnest([i, i + 1, i + 2]) AS p
            FROM windows JOIN (SELECT rid, g FROM windows GROUP BY ALL HAVING count(*) > 1) USING (rid, g))
        GROUP BY rid),
    counted AS (
        SELECT rid, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST({left_over("#*$%&|<>")} AS BIGINT) AS n_symbols,
               CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words, length(t) AS n_chars,
               [{classes}, CAST({others} AS BIGINT)] AS chars,
               list_concat([CAST(len(list_filter(common, lambda y: y = x)) AS BIGINT) FOR x IN {_list(WORD_BINS)}],
                           [CAST(len(list_filter(common, lambda y: list_contains({_list(SIGN_WORDS)}, y))) AS BIGINT)]) AS bins
        FROM parts LEFT JOIN again USING (rid)),
    shares AS (
        SELECT *, [x / CAST(greatest(n_chars, 1) AS DOUBLE) FOR x IN list_concat(chars, [greatest(0, n_chars - list_sum(chars))])] AS cs,
               [x / CAST(greatest(n_words, 1) AS DOUBLE) FOR x IN list_concat(bins, [greatest(0, n_words - list_sum(bins))])] AS ws
        FROM counted),
    long AS (SELECT * FROM shares WHERE n_words >= {limits.guard_words} AND list_contains({_list(COMMON_WORDS)}, lang)),
    means AS (
        SELECT kind, lang, list(m ORDER BY i) AS q FROM (
            SELECT kind, lang, i, CAST(sum(CAST(round(v[i] * 1e9) AS BIGINT)) AS DOUBLE) / (count(*) * 1e9) AS m
            FROM (SELECT kind, lang, v, unnest(range(1, len(v) + 1)) AS i
                  FROM (SELECT 'c' AS kind, lang, cs AS v FROM long UNION ALL SELECT 'w', lang, ws FROM long))
            GROUP BY ALL)
        GROUP BY kind, lang),
    near AS (
        SELECT rid, min(CASE WHEN kind = 'c' THEN d END) AS c, min(CASE WHEN kind = 'w' THEN d END) AS w
        FROM (SELECT rid, kind, {distance} AS d
              FROM (SELECT rid, means.kind, q, CASE WHEN means.kind = 'c' THEN cs ELSE ws END AS p FROM shares, means))
        GROUP BY rid),
    judged AS (
        SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.repeat_percent} * n_words AS base_failed
        FROM counted LEFT JOIN near USING (rid))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND (n_words < {limits.guard_words}
               OR coalesce(c, 0) <= {limits.char_distance} AND coalesce(judged.w, 0) <= {limits.word_distance}) AS kept
    FROM judged
    """


_REPEATS = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    words AS (SELECT rid, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
    windows AS (
        SELECT rid, doc_id, p, md5(string_agg(word, ' ') OVER ahead) AS g, count(*) OVER ahead AS n
        FROM words WINDOW ahead AS (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
    firsts AS (SELECT g, min(doc_id) AS least FROM windows WHERE n = 50 GROUP BY g),
    copied AS (SELECT rid, p FROM windows JOIN firsts USING (g) WHERE n = 50 AND (least < doc_id OR doc_id IS NULL AND least IS NOT NULL)),
    marked AS (
        SELECT words.rid, words.p, word,
               max(copied.p) OVER (PARTITION BY words.rid ORDER BY words.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
        FROM words LEFT JOIN copied ON words.rid = copied.rid AND words.p = copied.p),
    cut AS (
        SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
        FROM marked GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM docs LEFT JOIN cut USING (rid)
"""

_VARIANTS = r"""
    WITH RECURSIVE steps AS (
        SELECT list(c ORDER BY k) AS crc FROM (
            SELECT k, list_reduce([CAST(k AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
                                  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM range(256) AS t(k))),
    runs AS (
        SELECT doc_id, w, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w
            FROM documents)
        GROUP BY ALL),
    hashed AS (
        SELECT w, n, xor(4294967295, list_reduce(
            list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(octet_length(b)), lambda i: CAST('0x' || substr(hex(b), 2 * i + 1, 2) AS UBIGINT))),
            lambda c, x: xor(c >> 8, crc[CAST(xor(c, x) & 255 AS INTEGER) + 1]))) AS h
        FROM (SELECT w, n, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w) AS b FROM runs), steps),
    vocab AS (
        SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT CASE WHEN h % 31 = 0 THEN w[1 : CAST(h % length(w) AS INTEGER)] || w[CAST(h % length(w) AS INTEGER) + 2 :] ELSE w END AS w, n
            FROM hashed)
        WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
    cut AS (SELECT w, n, i, w[1 : i - 1] AS head, w[i + 1 :] AS tail FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM vocab)),
    shorter AS (SELECT DISTINCT cut.w AS x, v.w AS y FROM cut JOIN vocab v ON v.w = head || tail),
    near AS (
        SELECT a.w AS x, b.w AS y FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.w <> b.w
        UNION ALL SELECT x, y FROM shorter UNION ALL SELECT y, x FROM shorter),
    best AS (
        SELECT x, count(*) AS n_near, first(y ORDER BY n DESC, y) AS y, max(n) AS form_n
        FROM near JOIN vocab ON w = y GROUP BY x),
    formed AS (SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN y END AS form,
                      CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM vocab LEFT JOIN best ON x = w),
    walk AS (
        SELECT w, w AS reached FROM formed
        UNION ALL SELECT walk.w, form FROM walk JOIN formed ON formed.w = walk.reached WHERE form IS NOT NULL)
    SELECT w AS word, form, root, n, n_near, form_n
    FROM formed JOIN (SELECT walk.w, reached AS root FROM walk JOIN formed ON formed.w = reached WHERE form IS NULL) USING (w)
"""

ORACLE: dict[str, str] = {
    "op1_chat_collapse": _CHATS,
    "op5_winnowing": _BENCHMARK,
    "op6_quality_divergence": _quality(),
    "op11_substring_dedup": _REPEATS,
    "op12_spelling_variants": _VARIANTS,
}
