"""Expected rows of the queries that DuckDB can express, by the definition of each result rather than by its method."""

from quaystar.llm.mixing import REST as REST_STREAM
from quaystar.llm.quality_rules import COMMON_WORDS, Rules
from quaystar.llm.queries import REST, WEIGHTS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
RULES = Rules()


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- mixing: the schedule slot by slot -------------------------------------------------------------------------------

NAMES = [REST_STREAM, *WEIGHTS]
PARTS = [REST, *WEIGHTS.values()]
BLOCK = 16

MIXING = f"""
WITH RECURSIVE streams AS (
    SELECT * FROM (VALUES {", ".join(f"({k}, {_quoted(name)})" for k, name in enumerate(NAMES))}) t(k, stream)),
docs AS (
    SELECT doc_id, source, coalesce((SELECT k FROM streams WHERE k > 0 AND stream = source), 0) AS k FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS place FROM docs),
blocks AS (
    SELECT list(n ORDER BY k) AS blocks
    FROM (SELECT s.k, (count(d.k) + {BLOCK - 1}) // {BLOCK} AS n FROM streams s LEFT JOIN docs d ON s.k = d.k GROUP BY s.k)),
schedule AS (
    SELECT CAST(-1 AS BIGINT) AS slot, CAST(0 AS BIGINT) AS chosen, CAST(0 AS BIGINT) AS block, CAST(0 AS BIGINT) AS release,
           CAST(0 AS BIGINT) AS deadline, blocks AS remaining, [CAST(0 AS BIGINT) FOR x IN blocks] AS had,
           [CAST(0 AS BIGINT) FOR x IN blocks] AS share, [CAST(0 AS BIGINT) FOR x IN blocks] AS in_cycle, CAST(0 AS BIGINT) AS pos,
           true AS anew
    FROM blocks
    UNION ALL
    SELECT slot, chosen, had[chosen + 1], slot - pos + (in_cycle[chosen + 1] * total) // greatest(share[chosen + 1], 1),
           slot - pos + ((in_cycle[chosen + 1] + 1) * total + share[chosen + 1] - 1) // greatest(share[chosen + 1], 1),
           [remaining[x] - CASE WHEN x = chosen + 1 THEN 1 ELSE 0 END FOR x IN range(1, {len(PARTS) + 1})],
           [had[x] + CASE WHEN x = chosen + 1 THEN 1 ELSE 0 END FOR x IN range(1, {len(PARTS) + 1})], share,
           [CASE WHEN pos + 1 = total THEN 0 ELSE in_cycle[x] + CASE WHEN x = chosen + 1 THEN 1 ELSE 0 END END
            FOR x IN range(1, {len(PARTS) + 1})],
           CASE WHEN pos + 1 = total THEN 0 ELSE pos + 1 END,
           (pos + 1 = total AND len([x FOR x IN range(1, {len(PARTS) + 1})
                                    IF share[x] > 0 AND remaining[x] = CASE WHEN x = chosen + 1 THEN 1 ELSE 0 END]) > 0)
           OR (remaining[chosen + 1] = 1 AND in_cycle[chosen + 1] + 1 < share[chosen + 1])
    FROM (
        SELECT *, list_min([(((in_cycle[x] + 1) * total + share[x] - 1) // greatest(share[x], 1)) * 1000 + x - 1 FOR x IN range(1, {len(PARTS) + 1})
                            IF share[x] > in_cycle[x] AND (in_cycle[x] * total) // greatest(share[x], 1) <= pos]) % 1000 AS chosen
        FROM (
            SELECT slot + 1 AS slot, remaining, had, share, in_cycle, pos, CAST(list_sum(share) AS BIGINT) AS total
            FROM (
                SELECT slot, remaining, had, CASE WHEN anew THEN 0 ELSE pos END AS pos,
                       CASE WHEN anew THEN [CAST(CASE WHEN remaining[x] > 0 THEN {PARTS}[x] ELSE 0 END AS BIGINT)
                                            FOR x IN range(1, {len(PARTS) + 1})] ELSE share END AS share,
                       CASE WHEN anew THEN [CAST(0 AS BIGINT) FOR x IN remaining] ELSE in_cycle END AS in_cycle
                FROM schedule WHERE list_sum(remaining) > 0))))
SELECT doc_id, source, stream, block, release, deadline, slot, slot * {BLOCK} + place % {BLOCK} AS position
FROM placed JOIN streams USING (k) JOIN (SELECT * FROM schedule WHERE slot >= 0) s ON s.chosen = placed.k AND s.block = place // {BLOCK}"""

# --- quality rules ---------------------------------------------------------------------------------------------------

FORMS = ", ".join(
    f"({_quoted(lang)}, {_quoted(form + end)}, {k})"
    for lang, words in COMMON_WORDS.items()
    for k, word in enumerate(words)
    for form in dict.fromkeys((word, word.title()))
    for end in ("", ",", ".")
)
CLASSES = ["[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?''\"()\-]", r"[^\x00-\x7F]"]


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(t, '{pattern}'))"


def _divergence(counts: str, bins: str) -> str:
    """Divergence by document of counts (doc, language, bin, n); bins without a count are in the reference."""
    return f"""
        SELECT doc, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                        + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS divergence
        FROM (SELECT doc, bin, n / sum(n) OVER (PARTITION BY doc) AS p, r / sum(r) OVER (PARTITION BY doc) AS q
              FROM {counts} JOIN (SELECT language, bin, sum(n) AS r FROM {counts} GROUP BY ALL) USING (language, bin))
        GROUP BY doc"""


QUALITY = f"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS t, {WORDS} AS words,
           CASE WHEN lang IN ({", ".join(map(_quoted, COMMON_WORDS))}) THEN lang ELSE '' END AS language
    FROM documents),
word AS (SELECT doc, language, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM docs),
window3 AS (
    SELECT doc, i, count(*) OVER (PARTITION BY doc, w, w2, w3) AS n
    FROM (SELECT doc, i, w, lead(w, 1) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM word WINDOW d AS (PARTITION BY doc ORDER BY i))
    WHERE w3 IS NOT NULL),
repeated AS (
    SELECT doc, count(DISTINCT i) AS n FROM (SELECT doc, unnest([i, i + 1, i + 2]) AS i FROM window3 WHERE n > 1) GROUP BY doc),
forms AS (SELECT DISTINCT * FROM (VALUES {FORMS}) f(language, w, bin)),
common AS (SELECT doc, coalesce(bin, 25) AS bin, count(*) AS n FROM word LEFT JOIN forms USING (language, w) GROUP BY ALL),
common_bins AS (
    SELECT d.doc, language, b.bin, coalesce(n, 0) AS n
    FROM (SELECT doc, language FROM docs WHERE len(words) > 0) d CROSS JOIN (SELECT unnest(range(0, 26)) AS bin) b
         LEFT JOIN common c ON c.doc = d.doc AND c.bin = b.bin),
class_lists AS (
    SELECT doc, language, length(t) AS chars, [{", ".join(_count(c) for c in CLASSES)}] AS found FROM docs WHERE t <> ''),
class_bins AS (
    SELECT doc, language, unnest(found) AS n, unnest(range(0, 6)) AS bin FROM class_lists
    UNION ALL SELECT doc, language, chars - list_sum(found), 6 FROM class_lists),
by_class AS ({_divergence('class_bins', '7')}),
by_word AS ({_divergence('common_bins', '26')}),
base AS (
    SELECT doc, doc_id, language, CAST(len(words) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum([length(w) FOR w IN words]), 0) AS BIGINT) AS word_chars,
           CAST({_count('[#*$%&|<>]')} AS BIGINT) AS n_symbols,
           CAST(len([l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')])
                - len(list_distinct([l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')])) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
    FROM docs LEFT JOIN repeated r USING (doc))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {RULES.min_words} OR 100 * n_repeat_words > {RULES.max_repeat_percent} * n_words AS base_failed,
       NOT (n_words < {RULES.min_words} OR 100 * n_repeat_words > {RULES.max_repeat_percent} * n_words)
       AND (word_chars < {RULES.class_min_chars} OR c.divergence <= {RULES.max_class_divergence})
       AND (n_words < {RULES.word_min_words} OR language = '' OR w.divergence <= {RULES.max_word_divergence}) AS kept
FROM base LEFT JOIN by_class c USING (doc) LEFT JOIN by_word w USING (doc)"""

# --- repeated passages -----------------------------------------------------------------------------------------------

PASSAGES = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
    SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM docs WHERE len(words) >= 20)),
later AS (
    SELECT doc_id, s FROM windows
    QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
word AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM docs),
kept AS (
    SELECT doc_id, sha256(string_agg(w, ' ' ORDER BY i)) AS kept_sha256, count(*) AS n
    FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

ORACLES: dict[str, str] = {"op1_mixing": MIXING, "op3_quality_rules": QUALITY, "op10_substring_dedup": PASSAGES}
