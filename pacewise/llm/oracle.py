"""DuckDB SQL of the training-data queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

#: CTE of the 256 steps of CRC-32, and the checksum of a text's UTF-8 bytes with them.
_CRC_TABLE = """steps AS (
            SELECT i, i::BIGINT AS v, 0 AS k FROM range(256) r(i)
            UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8
        ),
        crc AS (SELECT list(v ORDER BY i) AS tab FROM steps WHERE k = 8)"""


def _crc(text: str) -> str:
    digits = f"hex(encode({text}))"
    each = f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {each}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


#: CTEs of the shingle sets, their links in both directions, and what links reach.
_LINKED = f"""        WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
        pairs AS (
            SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)
        ),
        links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)"""

_SQL = {
    "op1_jaccard_join": f"""{_LINKED}
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
        FROM d LEFT JOIN n ON d.doc_id = n.doc_id
    """,
    "jaccard_link_counts": f"""{_LINKED}
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT count(*) FROM links WHERE links.a = d.doc_id) AS n_links,
            (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
        FROM d LEFT JOIN n ON d.doc_id = n.doc_id
    """,
    "op4_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
        good AS (SELECT * FROM v WHERE list_dot_product(e, e) > 0 AND isfinite(list_dot_product(e, e))),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9
        ),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN least USING (vec_id)
    """,
    "op9_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
            FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)
        ),
        places AS (SELECT r, w, unnest(generate_series(1, len(w))) AS s FROM d WHERE len(w) > 0),
        hits AS (
            SELECT r, s, places.n, item
            FROM (SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS win FROM places, (SELECT DISTINCT n FROM windows) WHERE s + n - 1 <= len(w)) places
            JOIN windows ON windows.win = places.win AND windows.n = places.n
        ),
        cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY r),
        found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN cover USING (r) LEFT JOIN found USING (r)
    """,
    "op11_prefix_trie": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        t AS (
            SELECT conv_id AS c, strlen(coalesce(text, '')) AS bytes,
                length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '') AS say, turn
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        p AS (SELECT c, bytes, sha256(say) AS id, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(say)) AS pos FROM t),
        h AS (SELECT c, {_crc("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM t), crc),
        turns AS (
            SELECT h.c, 0 AS own, p.pos, id, bytes FROM h JOIN p ON p.c = h.c - h.c % 5 AND p.pos <= h.h
            UNION ALL SELECT h.c, 1, p.pos, id, bytes FROM h JOIN p ON p.c = h.c AND p.pos > h.h
        ),
        r AS (SELECT h.c, coalesce(list(id ORDER BY own, pos) FILTER (id IS NOT NULL), []) AS ids, list(bytes ORDER BY own, pos) FILTER (id IS NOT NULL) AS sizes
            FROM h LEFT JOIN turns ON turns.c = h.c GROUP BY h.c),
        pre AS (SELECT c, len(ids) AS n, unnest(range(0, len(ids) + 1)) AS depth, ids, sizes FROM r),
        named AS (SELECT c, n, depth, sha256(array_to_string(ids[1:depth], ',')) AS node, CASE WHEN depth > 0 THEN sha256(array_to_string(ids[1 : depth - 1], ',')) END AS parent,
            CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size FROM pre),
        nodes AS (
            SELECT node, depth, min(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
            FROM named GROUP BY node, depth
        ),
        below AS (SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
        own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN below ON nodes.node = below.parent),
        up AS (SELECT node, node AS above FROM own UNION ALL SELECT up.node, own.parent FROM up JOIN own ON up.above = own.node WHERE own.parent IS NOT NULL),
        sums AS (
            SELECT above AS node, sum((own.n_children = 0)::INT)::BIGINT AS n_leaves, sum((own.n_convs - 1) * own.size)::BIGINT AS saved_tokens
            FROM up JOIN own ON up.node = own.node GROUP BY above
        )
        SELECT own.conv_id, own.depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens, own.ends_sha256
        FROM own JOIN sums ON own.node = sums.node LEFT JOIN own up ON own.parent = up.node
    """,
    "op13_spelling_variants": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        found AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
        runs AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY ALL),
        hashed AS (SELECT run, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc),
        lost AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM lost WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        gaps AS (
            SELECT word, n, p, substr(word, p, 1) AS letter, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)
        ),
        shorter AS (SELECT DISTINCT g.word AS a, g.n AS a_n, w.word AS b, w.n AS b_n FROM gaps g JOIN words w ON g.rest = w.word),
        near AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.p = b.p AND a.rest = b.rest AND a.letter <> b.letter
            UNION ALL SELECT a, b, b_n FROM shorter UNION ALL SELECT b, a, a_n FROM shorter
        ),
        best AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n FROM near GROUP BY word),
        first AS (SELECT word, n_near, form_n, (SELECT min(near) FROM near WHERE near.word = best.word AND near_n = form_n) AS form FROM best),
        forms AS (SELECT words.word, words.n, form, form_n FROM words JOIN first USING (word) WHERE form_n >= 10 * words.n),
        paths AS (SELECT word, form AS root FROM forms UNION ALL SELECT paths.word, forms.form FROM paths JOIN forms ON paths.root = forms.word),
        ends AS (SELECT word, root FROM paths WHERE root NOT IN (SELECT word FROM forms))
        SELECT words.word, forms.form, coalesce(ends.root, words.word) AS root, words.n, coalesce(first.n_near, 0)::BIGINT AS n_near, forms.form_n
        FROM words LEFT JOIN first USING (word) LEFT JOIN forms ON forms.word = words.word LEFT JOIN ends ON ends.word = words.word
    """,
}


def statements() -> dict[str, str]:
    return dict(_SQL)
