"""DuckDB SQL of the registered queries that SQL can express.

The others fit models, use a tokenizer or read markup; tests hold them against plain versions.
"""

from __future__ import annotations

from tamis.llm import mixing, ngram_join, quality_rules, vector_join
from tamis.llm.quality_rules import RULES
from tamis.llm.substring_dedup import WINDOW

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _roots(nodes: str, links: str) -> str:
    """A CTE ``roots`` (node, root): the smallest node that each one of ``nodes`` reaches."""
    return f"""reach(node, root) AS (
        SELECT node, node FROM {nodes}
        UNION SELECT l.b, r.root FROM reach r JOIN {links} l ON l.a = r.node),
    roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""


_MIX = f"""WITH
    docs AS (SELECT doc_id, source, len({_WORDS}) AS size,
        length(translate(coalesce(text, ''), '#*$%&|<>!?~^=_/\\{{}}[]()@+0123456789', ''))
            / greatest(length(coalesce(text, '')), 1) AS share,
        ('0x' || substr(md5('{mixing.SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT AS bits
        FROM documents),
    keyed AS (SELECT *, -ln((bits + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
        / greatest(share * share, 0.25) AS key FROM docs),
    sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
    weighed AS (SELECT *, {list(mixing.WEIGHTS)}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1)
        % {len(mixing.WEIGHTS)}] AS weight, {mixing.MAX_EPOCHS}::DOUBLE * source_size AS bound FROM sizes),
    -- sources reach their bounds in the order of bound by weight
    ordered AS (SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(bound) OVER (ORDER BY bound / weight, source ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), 0) AS bounded,
        sum(weight) OVER (ORDER BY bound / weight, source ROWS BETWEEN CURRENT ROW
            AND UNBOUNDED FOLLOWING) AS free FROM weighed),
    level AS (SELECT arg_min((total - bounded) / free, bound / weight) AS level FROM ordered
        WHERE (total - bounded) / free <= bound / weight),
    goals AS (SELECT source, source_size, least(weight * level, bound) AS target FROM ordered, level),
    budgets AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
        FROM goals),
    summed AS (SELECT doc_id, k.source, size, source_size, target, epochs,
        target - epochs * source_size AS budget,
        sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
            ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
        FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, size, source_size, target,
        CAST(size * (epochs + CASE WHEN middle <= budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM summed"""

_NEAR_VECTORS = f"""WITH RECURSIVE
    good AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    linked AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
        ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
        AND list_cosine_similarity(x.v, y.v) >= {vector_join.LEAST}),
    {_roots("(SELECT vec_id AS node FROM embeddings)", "linked")},
    counts AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, root AS component_id, vec_id = root AS kept
    FROM embeddings JOIN roots ON vec_id = node LEFT JOIN counts ON vec_id = a"""


def _near_documents(rule: ngram_join.Rule) -> str:
    size = rule.words
    return f"""WITH RECURSIVE
    lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    split AS (SELECT doc_id, {_WORDS} AS w FROM lowered),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [w]
        ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}),
            lambda i: list_slice(w, i, i + {size - 1}))) END AS s FROM split),
    sizes AS (SELECT doc_id, len(s) AS n FROM sets),
    shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y
        ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    linked AS (SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
        WHERE 100 * c >= {rule.percent} * (p.n + q.n - c)),
    {_roots("(SELECT doc_id AS node FROM documents)", "linked")}
    SELECT doc_id, n AS n_shingles, root AS component_id FROM sizes JOIN roots ON doc_id = node"""


def _quality() -> str:
    def without(characters: str) -> str:
        return f"length(translate(t, '{characters}', ''))"

    spaces = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"
    shares = {
        "symbol_share": ("n_symbols", "word_chars", 1000),
        "mark_share": ("marks", "word_chars", 1000),
        "capital_share": ("capitals", "word_chars", 1000),
        "digit_share": ("digits", "word_chars", 1000),
        "repeat_share": ("n_repeat_words", "n_words", 1000),
        "line_share": ("n_dup_lines", "lines", 1000),
        "word_length": ("word_chars", "n_words", 100),
    }
    measures = ", ".join(
        f"{scale} * {part} // greatest({whole}, 1) AS {name}" for name, (part, whole, scale) in shares.items()
    )
    buckets = " UNION ALL ".join(
        f"SELECT lang, source, {n} AS rule, {r.name} // {r.width} AS bucket FROM measured WHERE NOT base_failed"
        for n, r in enumerate(RULES)
    )
    fences, fine = [], ["NOT base_failed"]
    for n, r in enumerate(RULES):
        q1, q3 = f"q1 * {r.width}", f"(q3 + 1) * {r.width}"
        reach = f"greatest({r.spread} * ({q3} - {q1}), {r.margin})"
        fences.append(f"max(CASE WHEN rule = {n} THEN {q3} + {reach} END) AS {r.name}_high")
        fine.append(f"coalesce({r.name} <= {r.name}_high, true)")
        if r.below:
            fences.append(f"max(CASE WHEN rule = {n} THEN {q1} - {reach} END) AS {r.name}_low")
            fine.append(f"coalesce({r.name} >= {r.name}_low, true)")
    group = "lang, source, rule"
    same = "m.lang IS NOT DISTINCT FROM c.lang AND m.source IS NOT DISTINCT FROM c.source"
    return rf"""WITH
    docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
    windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM docs WHERE len(w) > 2),
    timed AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat FROM
        (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM timed WHERE n > 1) GROUP BY doc_id),
    counted AS (SELECT docs.doc_id, lang, source, len(w) AS n_words,
        length(translate(t, {spaces}, '')) AS word_chars,
        length(t) - {without(quality_rules.SYMBOLS)} AS n_symbols,
        length(t) - {without('!?~^=_/' + chr(92) + '{}[]@')} AS marks,
        length(t) - {without(capitals)} AS capitals,
        length(t) - {without('0123456789')} AS digits,
        len(string_split(t, chr(10))) AS lines,
        len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(t, chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
        coalesce(n_repeat, 0) AS n_repeat_words
        FROM docs LEFT JOIN covered ON docs.doc_id = covered.doc_id),
    measured AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
        OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT} * n_words AS base_failed, {measures} FROM counted),
    sketch AS (SELECT {group}, bucket, count(*) AS n FROM ({buckets}) GROUP BY ALL),
    ranked AS (SELECT *, sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY {group}) AS total FROM sketch),
    quartiles AS (SELECT {group}, min(CASE WHEN 4 * upto >= total THEN bucket END) AS q1,
        min(CASE WHEN 4 * upto >= 3 * total THEN bucket END) AS q3 FROM ranked GROUP BY ALL),
    cut AS (SELECT lang, source, {", ".join(fences)} FROM quartiles GROUP BY lang, source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        {" AND ".join(fine)} AS kept, {", ".join(shares)}
    FROM measured m LEFT JOIN cut c ON {same}"""


_CHAT = """WITH
    turns AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k,
        count(*) OVER (PARTITION BY conv_id) AS n_turns,
        coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n') || chr(2) AS own,
        '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || trim(coalesce(text, '')) || chr(10)
            || '<|end|>' || chr(10) AS piece FROM conversations),
    upto AS (SELECT conv_id, k, n_turns, md5(string_agg(own, '') OVER
        (PARTITION BY conv_id ORDER BY k)) AS h FROM turns),
    whole AS (SELECT h, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies
        FROM upto WHERE k = n_turns GROUP BY h),
    texts AS (SELECT conv_id, string_agg(piece, '' ORDER BY k) AS rendered FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, n_copies, rendered FROM whole JOIN texts USING (conv_id)
    WHERE h NOT IN (SELECT h FROM upto WHERE k < n_turns)"""

_REPEATS = f"""WITH
    split AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w
        FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
    held AS (SELECT r, doc_id, unnest(list_transform(range(1, len(w) - {WINDOW - 2}),
        lambda i: {{'i': i, 't': array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')}})) AS h
        FROM split WHERE len(w) >= {WINDOW}),
    first AS (SELECT h.t AS t, min(doc_id) AS first FROM held GROUP BY ALL),
    gone AS (SELECT DISTINCT r, unnest(range(h.i, h.i + {WINDOW})) AS i
        FROM held JOIN first f ON h.t = f.t WHERE f.first < doc_id),
    placed AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN gone USING (r, i)
        GROUP BY r),
    counts AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
        sha256(coalesce(k.text, '')) AS kept_sha256
    FROM split LEFT JOIN kept k USING (r) LEFT JOIN counts USING (r)"""

_MINED = """WITH
    rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        list_inner_product(a.v, b.v)::BIGINT AS score
        FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
    positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
    ranked AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
        FROM positive JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    FROM ranked WHERE rank <= 3"""

ORACLE: dict[str, str] = {
    "op1_mixing": _MIX,
    "op7_vector_join": _NEAR_VECTORS,
    "op8_ngram_join": _near_documents(ngram_join.Rule(words=4, percent=85)),
    "op9_quality_rules": _quality(),
    "op10_chat_format": _CHAT,
    "op11_substring_dedup": _REPEATS,
    "op13_hard_negatives": _MINED,
}
