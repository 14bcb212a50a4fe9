"""SQL twins of the queries that SQL can state over the whole tables."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_FEATURES = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LETTERS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"

ORACLES = {
    "op2_near_duplicates": f"""
        WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN edges l ON l.a = r.b)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, low AS component_id, doc_id = low AS kept
        FROM documents LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)""",
    "op4_exact_duplicates": r"""
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM (SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
                count(*) OVER (PARTITION BY body) AS group_size
            FROM (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents))""",
    "op10_decontamination": f"""
        WITH docs AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
        items AS (SELECT item_id, {_LETTERS} AS w FROM benchmark),
        doc_at AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
        item_at AS (SELECT item_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT item_id, w, unnest(range(1, len(w) - 1)) AS i FROM items WHERE len(w) >= 11)),
        doc_word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS a FROM docs),
        short_at AS (SELECT item_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS a FROM items WHERE len(w) < 11),
        shifts AS (
            SELECT DISTINCT d.doc_id, t.item_id, d.i - t.i AS shift FROM doc_at d JOIN item_at t USING (a, b, c)
            UNION SELECT d.doc_id, t.item_id, d.i - t.i FROM doc_word d JOIN short_at t USING (a)),
        same AS (
            SELECT doc_id, item_id, shift, k, len(iw) AS n, least(len(iw), 20) AS size,
                (k + shift BETWEEN 1 AND len(dw) AND dw[greatest(k + shift, 1)] = iw[k])::INT AS hit
            FROM (SELECT s.*, d.w AS dw, t.w AS iw, unnest(range(1, len(t.w) + 1)) AS k FROM shifts s JOIN docs d USING (doc_id) JOIN items t USING (item_id))),
        stretches AS (
            SELECT *, sum(hit) OVER (PARTITION BY doc_id, item_id, shift ORDER BY k)
                - coalesce(sum(hit) OVER (PARTITION BY doc_id, item_id, shift ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 20 PRECEDING), 0) AS last
            FROM same),
        best AS (
            SELECT doc_id, item_id, size, last AS matched, k - size + shift AS start FROM stretches WHERE k >= size AND last * 100 >= size * 75)
        SELECT doc_id, item_id, max(matched)::BIGINT AS matched_words, any_value(size)::BIGINT AS window_words,
            arg_min(start, struct_pack(m := -matched, s := start))::BIGINT AS doc_start
        FROM best GROUP BY doc_id, item_id""",
    "op12_resampling": f"""
        WITH crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(
                list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        docs AS (SELECT doc_id, {_FEATURES} AS w FROM documents),
        items AS (SELECT {_FEATURES} AS w FROM benchmark),
        doc_words AS (SELECT doc_id, unnest(w) AS word FROM docs),
        item_words AS (SELECT unnest(w) AS word FROM items),
        bytes AS (
            SELECT word, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: ('0x' || x)::BIGINT) AS b
            FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words)),
        bucket_of AS (
            SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
            FROM bytes, crc_table),
        s AS (SELECT bucket, count(*) AS n FROM doc_words JOIN bucket_of USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM item_words JOIN bucket_of USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
                / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)),
        weights AS (SELECT doc_id, sum(gain) AS weight FROM doc_words JOIN bucket_of USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
            FROM docs LEFT JOIN weights USING (doc_id)),
        ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM ranks) THEN rank END AS rank
        FROM scored LEFT JOIN ranks USING (doc_id)""",
}
