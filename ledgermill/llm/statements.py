"""DuckDB statements for the queries that SQL can express.

The others depend on learned models, token ids, covariance estimates or a parser; their tests hold them against
plain Python.
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"


def _runs(n: int) -> str:
    """Runs of ``n`` words of ``words`` (doc_id, i, word): doc_id, i of the first, run, size."""
    frame = f"OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
    return f"SELECT doc_id, i, string_agg(word, ' ') {frame} AS run, count(*) {frame} AS size FROM words"


def _words(text: str) -> str:
    return f"""
        lists AS (SELECT doc_id, coalesce(regexp_extract_all({text}, '{_WORDS}'), []) AS list FROM documents),
        words AS (SELECT doc_id, unnest(list) AS word, unnest(range(len(list))) AS i FROM lists)"""


def _similar(percent: int, more: str = "") -> str:
    """Documents with the smallest id that links of similar shingle sets reach."""
    return f"""
        WITH RECURSIVE {_words(_LOWER)},
        shingles AS (SELECT DISTINCT doc_id, run FROM ({_runs(5)}) r JOIN lists USING (doc_id)
                     WHERE size = 5 OR (i = 0 AND len(list) < 5)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (run)
                   WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
        links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
                  WHERE 100 * common >= {percent} * (p.n + q.n - common)),
        reached AS (SELECT doc_id, doc_id AS other FROM lists
                    UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id{more}
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n"""


def _crc32(text: str) -> str:
    """Of an ASCII text: the bytes shifted through the reflected polynomial, bit by bit."""
    bit = "lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END"
    byte = f"lambda crc, b: list_reduce(range(8), {bit}, xor(crc, b))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce({codes}, {byte}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _way(cost: str, letter: str, shown: str, rest: str) -> str:
    """An edit in front of the way ``rest``; ``shown`` is what it adds to the repaired text."""
    return f"{{'cost': {rest}.cost + {cost}, 'audit': '{letter}' || {rest}.audit, 'made': {shown} || {rest}.made}}"


def _row_ways(keeps: dict[str, str], role: str, own: str) -> str:
    """The cheapest way from a row on: from state ``own``, by initial kept the next state, and the role that fits."""
    turn = f"w.{role[0]}"
    row = "chr(10) || role || ':' || text"
    more = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    never = "{'cost': 1000000, 'audit': '~', 'made': ''}"
    kept = " ".join(f"WHEN head = '{initial}' THEN {_way(more, 'K', row, to)}" for initial, to in keeps.items())
    rerole = _way(f"3 + {more}", "R", f"chr(10) || '{role}:' || text", turn)
    stays = f"least(CASE {kept} ELSE {never} END, {rerole})"
    return f"least({_way('4', 'D', chr(39) * 2, own)}, CASE WHEN fault IN ('blank', 'duplicate') THEN {never} ELSE {stays} END)"


def _inserted(role: str, rest: str) -> str:
    return _way("3", "I", f"chr(10) || '{role}:'", rest)


STATEMENTS: dict[str, str] = {
    "op1_substring_dedup": f"""
        WITH {_words('text')},
        windows AS (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS place
                    FROM ({_runs(20)}) r WHERE size = 20),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM windows WHERE place > 1),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i)
                 GROUP BY doc_id)
        SELECT doc_id, len(list) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM lists LEFT JOIN kept USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)""",
    "op2_minhash": _similar(75, ", doc_id = min(other) AS kept"),
    "op13_ngram_join": _similar(80),
    "op4_decontamination": f"""
        WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS list FROM documents WHERE text IS NOT NULL),
        items AS (SELECT item_id, list, len(list) AS n, least(len(list), 5) AS size
                  FROM (SELECT DISTINCT item_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS list FROM benchmark WHERE text IS NOT NULL) b
                  WHERE len(list) > 0),
        item_runs AS (SELECT item_id, n, size, run, count(*) AS often
                      FROM (SELECT *, array_to_string(list[p + 1:p + size], ' ') AS run FROM (SELECT *, unnest(range(n - size + 1)) AS p FROM items) i) r
                      GROUP BY ALL),
        runs AS (SELECT doc_id, words, size, p, array_to_string(list[p + 1:p + size], ' ') AS run
                 FROM (SELECT doc_id, list, len(list) AS words, size, unnest(range(len(list) - size + 1)) AS p
                       FROM docs, (SELECT DISTINCT size FROM items) s WHERE len(list) >= size) d),
        hits AS (SELECT doc_id, item_id, size, run, p, often, n - size + 1 AS item_size, least(n, words) AS width, words
                 FROM runs JOIN item_runs USING (size, run)),
        shared AS (SELECT doc_id, item_id, size, item_size, width, start, run, least(count(*), often) AS common
                   FROM (SELECT *, unnest(range(greatest(0, p - (width - size)), least(p, words - width) + 1)) AS start FROM hits) h
                   GROUP BY doc_id, item_id, size, item_size, width, start, run, often),
        windows AS (SELECT doc_id, item_id, start, width, sum(common) / (width - size + 1 + item_size - sum(common)) AS similarity
                    FROM shared GROUP BY doc_id, item_id, start, width, size, item_size)
        SELECT doc_id, item_id, start, width AS n_words, similarity
        FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS place
              FROM windows WHERE similarity >= 0.75) w WHERE place = 1""",
    # States of the way that is left: n nothing yet, s after a system row, u after a user row, a after an assistant row.
    "op11_conversation_repair": f"""
        WITH RECURSIVE kinds AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
            FROM conversations),
        hurt AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM kinds),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM hurt),
        rows AS (
            SELECT conv_id, turn, role, text, i, left(role, 1) AS head,
                   left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pair,
                   CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault
            FROM placed),
        ways AS (
            SELECT conv_id, max(i) + 1 AS i, {{'cost': 0, 'audit': '', 'made': ''}} AS n,
                   {{'cost': 6, 'audit': 'II', 'made': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s,
                   {{'cost': 3, 'audit': 'I', 'made': chr(10) || 'assistant:'}} AS u,
                   {{'cost': 0, 'audit': '', 'made': ''}} AS a
            FROM rows GROUP BY conv_id
            UNION ALL
            SELECT conv_id, i, least(n, {_inserted("user", "u2")}), least(s, {_inserted("user", "u2")}), u2, least(a, {_inserted("user", "u")})
            FROM (SELECT *, least(u, {_inserted("assistant", "a")}) AS u2
                  FROM (SELECT r.conv_id, r.i, {_row_ways({"s": "w.s", "u": "w.u"}, "user", "w.n")} AS n,
                               {_row_ways({"u": "w.u"}, "user", "w.s")} AS s,
                               {_row_ways({"a": "w.a"}, "assistant", "w.u")} AS u,
                               {_row_ways({"u": "w.u"}, "user", "w.a")} AS a
                        FROM ways w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i - 1) q) p),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(n.cost, 0)::BIGINT AS cost,
               coalesce(n.audit, '') AS audit, sha256(coalesce(n.made[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN ways w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 1""",
    "op12_prefix_trie": f"""
        WITH own AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS i,
                   md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
                   len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS words
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own) c),
        built AS (
            SELECT c.conv_id, i, mark, words FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND i < h
            UNION ALL SELECT c.conv_id, i, mark, words FROM convs c JOIN own o USING (conv_id) WHERE i >= h),
        paths AS (
            SELECT conv_id, row_number() OVER w AS depth, string_agg(mark, '') OVER w AS path, words
            FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY i)
            UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
        nodes AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, left(path, 32 * (depth - 1)::INT) AS up
            FROM paths GROUP BY path, depth),
        kids AS (SELECT up AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
        below AS (
            SELECT left(path, 32 * d) AS path, count(*) FILTER (n IS NULL) AS n_leaves, sum((n_convs - 1) * words) AS saved
            FROM (SELECT path, n, n_convs, words, unnest(range(depth + 1))::INT AS d FROM nodes LEFT JOIN kids USING (path)) x GROUP BY ALL),
        ends AS (
            SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
            FROM (SELECT conv_id, max_by(path, depth) AS path FROM paths GROUP BY conv_id) e GROUP BY path)
        SELECT x.conv_id, x.depth, CASE WHEN x.depth > 0 THEN p.conv_id END AS parent_conv_id, x.n_convs, coalesce(n, 0) AS n_children,
               n_leaves, saved::BIGINT AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
        FROM nodes x LEFT JOIN nodes p ON p.path = x.up AND p.depth = x.depth - 1
        LEFT JOIN kids k ON k.path = x.path JOIN below b ON b.path = x.path LEFT JOIN ends e ON e.path = x.path""",
}
