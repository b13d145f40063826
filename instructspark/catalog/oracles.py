"""DuckDB SQL for the registered queries, written from their definitions."""

from __future__ import annotations

from instructspark import fixed_values as fixed
from instructspark.catalog import given_tables as given
from instructspark.catalog.queries import (
    DOCUMENT_ALPHABET,
    DOCUMENT_DENSITY,
    WIDE_FLOOR,
    WIDE_SPAN,
)
from instructspark.functions.prompts import REWRITE_TEMPLATE, SYSTEM_MESSAGE

FIELDS = [text for text, _ in fixed.COLUMN_PAIRS]
SIX = ", ".join(["row_id", *fixed.RAW_COLUMNS])
WORD_GAP = r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\p{Z}]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_text(fixed.WHITESPACE)})"


def _blank(x: str) -> str:
    return f"({_strip(f'coalesce({x}, {_text("")})')} = '')"


def _words(x: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(lower({x}), {_text(WORD_GAP)}), lambda w: w <> ''))"


def _any(form: str, needles: list[str]) -> str:
    return "(" + " OR ".join(form.format(_text(n)) for n in needles) + ")"


def _skip(text: str, ref: str) -> str:
    bare = _strip(text)
    return f"({bare} = '' OR {bare} = {_strip(ref)} OR length({bare}) < {fixed.MIN_TEXT_CHARS})"


def _line(response: str) -> str:
    unmarked = _any("contains(lower(l), {})", fixed.PREAMBLE_MARKERS)
    lines = f"list_transform(string_split({_strip(response)}, chr(10)), lambda l: {_strip('l')})"
    return f"list_filter({lines}, lambda l: length(l) > {fixed.MIN_LINE_CHARS} AND NOT {unmarked})[1]"


def _marked(response: str) -> str:
    return _any(f"starts_with(lower({_strip(response)}), {{}})", fixed.PREAMBLE_MARKERS)


def _overlap(response: str, text: str) -> str:
    known = _words(text)
    return f"(len(list_intersect({known}, {_words(response)}))::DOUBLE / greatest(len({known}), 1))"


def _reason(response: str, text: str) -> str:
    bare = _strip(response)
    return f"""CASE
        WHEN {response} IS NULL THEN 'missing'
        WHEN length({bare}) < {fixed.MIN_RESPONSE_CHARS} THEN 'short'
        WHEN {_marked(response)} AND {_line(response)} IS NOT NULL THEN 'marker_line'
        WHEN {_marked(response)} THEN 'marker_only'
        WHEN {_overlap(bare, text)} < {fixed.MIN_WORD_OVERLAP}::DOUBLE THEN 'overlap'
        WHEN length({bare}) > {fixed.MAX_GROWTH} * length({text}) + {fixed.GROWTH_SLACK} THEN 'runaway'
        ELSE 'ok' END"""


def _result(reason: str, response: str, text: str) -> str:
    return f"""CASE {reason} WHEN 'ok' THEN {_strip(response)}
        WHEN 'marker_line' THEN {_line(response)} ELSE {text} END"""


def _task_type(text: str) -> str:
    whens = " ".join(
        f"WHEN {_any(f'contains(lower({text}), {{}})', keywords)} THEN {_text(label)}"
        for label, keywords in fixed.TASK_KEYWORDS.items()
    )
    return f"CASE {whens} ELSE {_text(fixed.OTHER_TASK)} END"


def _content(instruction: str, context: str) -> str:
    return (
        f"coalesce({instruction}, '') || CASE WHEN {_blank(context)} THEN '' "
        f"ELSE chr(10) || chr(10) || {context} END"
    )


def _response(kind: str, text: str, other: str) -> str:
    return f"""CASE {kind}
        WHEN 0 THEN NULL
        WHEN 1 THEN {_text(given.SHORT_RESPONSE)}
        WHEN 2 THEN {_text(given.MARKER_HEAD)} || replace({text}, chr(10), ' ')
        WHEN 3 THEN {_text(given.MARKER_ONLY)}
        WHEN 4 THEN {other}
        WHEN 5 THEN repeat({text} || ' ', 5)
        WHEN 6 THEN chr(9) || ' ' || {text} || chr(160) || ' '
        ELSE replace({text}, 'the ', 'en ') END"""


PREFIX = "CASE (conv_id * 7 + turn) % 8 " + " ".join(
    f"WHEN {i} THEN {_text(prefix)}" for i, prefix in enumerate(given.TASK_PREFIXES)
) + " END"

# Named table expressions; each query takes those it needs, in this order.
TABLES = {
    "turns": f"""
        WITH met AS (
            SELECT u.conv_id, u.turn, u.text AS said, a.text AS output, coalesce(s.text, '') AS input
            FROM conversations u
            LEFT JOIN conversations a
                ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
            LEFT JOIN conversations s
                ON s.conv_id = u.conv_id AND s.turn = u.turn - 1 AND s.role = 'system'
            WHERE u.role = 'user')
        SELECT * FROM met
        UNION ALL
        SELECT conv_id, turn + {given.COMPANION_TURN}, {_text(given.SHORT_INSTRUCTION)}, output, input
        FROM met WHERE (conv_id + turn) % 7 = 0""",
    "inst": f"""
        SELECT conv_id * {given.TURN_SPACE} + turn AS row_id, conv_id, turn, said AS instruction,
            input, output, {PREFIX} || said AS instruction_en,
            CASE WHEN (conv_id + turn) % 5 = 0 OR input = '' THEN input ELSE input || ' (en)' END AS input_en,
            CASE WHEN (conv_id + turn) % 5 = 0 THEN output ELSE output || ' (en)' END AS output_en
        FROM turns""",
    "pairs": " UNION ALL ".join(
        f"SELECT row_id, '{text}' AS field, coalesce({text}, '') AS text, coalesce({ref}, '') AS ref_text FROM inst"
        for text, ref in fixed.COLUMN_PAIRS
    ),
    "responses": " UNION ALL ".join(
        f"""
        SELECT row_id, '{text}' AS field,
            {_response(f'(conv_id + turn + {i}) % 8', text, other)} AS response, 1 AS attempt
        FROM inst WHERE (conv_id * 3 + turn) % 5 <> 0
        UNION ALL
        SELECT row_id, '{text}', {text} || ' igjen.', 2
        FROM inst WHERE (conv_id * 3 + turn) % 5 <> 0 AND (conv_id + turn) % 3 = 0"""
        for i, (text, other) in enumerate(
            [("instruction", "output"), ("input", "instruction"), ("output", "instruction")]
        )
    ),
    "latest": """
        SELECT row_id, field, response, attempt FROM responses WHERE response IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY row_id, field
            ORDER BY attempt DESC, response DESC NULLS LAST) = 1""",
    "answered": "SELECT p.*, l.response FROM pairs p LEFT JOIN latest l USING (row_id, field)",
    "kept": f"""
        SELECT row_id, field, text,
            CASE WHEN NOT {_skip('text', 'ref_text')} THEN response END AS kept
        FROM answered""",
    "coded": f"SELECT *, {_reason('kept', 'text')} AS reason FROM kept",
    "results": f"SELECT row_id, field, {_result('reason', 'kept', 'text')} AS result FROM coded",
    "improved": f"SELECT {SIX}, "
    + ", ".join(
        f"(SELECT result FROM results r WHERE r.row_id = i.row_id AND r.field = '{f}') AS {f}_improved"
        for f in FIELDS
    )
    + " FROM inst i",
    "prepared": f"""
        SELECT *, 1::INTEGER AS messages, 'user' AS role,
            {_content('instruction_improved', 'input_improved')} AS content,
            {_task_type('instruction_en')} AS task_type
        FROM improved""",
    "labelled": f"""
        SELECT row_id, {_content('instruction', 'input')} AS content,
            {_task_type('instruction_en')} AS task_type
        FROM inst""",
    "generated": """
        SELECT m.*, CASE WHEN (conv_id * 5 + turn) % 11 <> 0
            THEN ' ' || replace(i.output, 'and ', 'og ') END AS output_generated
        FROM improved m JOIN inst i USING (row_id)""",
    "polish_coded": f"""
        SELECT *, {_reason('kept', "coalesce(output_generated, '')")} AS reason
        FROM (
            SELECT g.*, CASE WHEN NOT {_skip("coalesce(output_generated, '')", 'g.instruction_en')}
                THEN {_response('(i.conv_id * 3 + i.turn) % 8', 'i.output', 'i.instruction')} END AS kept
            FROM generated g JOIN inst i USING (row_id)
        )""",
    "polished": f"""
        SELECT * EXCLUDE (kept, reason),
            {_result('reason', 'kept', "coalesce(output_generated, '')")} AS output_polished
        FROM polish_coded""",
    "refs": f"""
        SELECT conv_id AS prompt_id, output AS output_improved,
            {_task_type('instruction_en')} AS task_type, e.embedding AS reference_embedding
        FROM (
            SELECT * FROM inst WHERE output IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1
        )
        LEFT JOIN embeddings e ON e.vec_id = conv_id * 3 % (SELECT count(*) FROM embeddings)""",
    "paired": f"""
        SELECT r.prompt_id, c.conv_id * {given.TURN_SPACE} + c.turn AS completion_id,
            c.text AS completion, r.output_improved, r.task_type,
            e.embedding AS completion_embedding, r.reference_embedding
        FROM conversations c JOIN refs r ON r.prompt_id = c.conv_id
        LEFT JOIN embeddings e
            ON e.vec_id = (c.conv_id * 3 + c.turn - 1) % (SELECT count(*) FROM embeddings)
        WHERE c.role = 'assistant'""",
    "scored": "",
    "totals": "",
}


def _counts(text: str) -> str:
    """What the letter-counting encoder of ``embed_rewards`` gives, before its length is one."""
    return ", ".join(
        [*(f"length({text}) - length(replace({text}, '{c}', ''))" for c in ("a", "e", " ")), f"length({text})"]
    )


def _semantic(left: str, right: str, floor: float, span: float) -> str:
    dot = f"list_inner_product({left}::DOUBLE[], {right}::DOUBLE[])"
    return f"greatest(0::DOUBLE, least(1::DOUBLE, ({dot} - {floor}::DOUBLE) / {span}::DOUBLE))"


def _language(text: str, alphabet: str, density: float) -> str:
    own = f"length(regexp_replace({text}, '[^{alphabet}]', '', 'g'))"
    return f"""CASE WHEN {_blank(text)} THEN 0::DOUBLE ELSE {fixed.LANGUAGE_BASE}::DOUBLE
        + least({1 - fixed.LANGUAGE_BASE}::DOUBLE, {own} / (length({text}) * {density}::DOUBLE)) END"""


def _length(text: str, ref: str) -> str:
    ratio = f"(length({text})::DOUBLE / greatest(length({ref}), 1))"
    (f0, f1), (h0, h1) = fixed.LENGTH_FULL, fixed.LENGTH_HALF
    return f"""CASE WHEN {ratio} >= {f0}::DOUBLE AND {ratio} <= {f1}::DOUBLE THEN 1::DOUBLE
        WHEN {ratio} < {h0}::DOUBLE OR {ratio} > {h1}::DOUBLE THEN 0::DOUBLE ELSE 0.5::DOUBLE END"""


def _accuracy(text: str, ref: str, task: str) -> str:
    said, wanted = f"lower({_strip(text)})", f"lower({_strip(ref)})"
    tasks = ", ".join(_text(t) for t in fixed.VERIFIABLE_TASKS)
    return f"""CASE WHEN {task} NOT IN ({tasks}) THEN 0::DOUBLE WHEN {said} = {wanted} THEN 1::DOUBLE
        WHEN contains({said}, {wanted}) OR contains({wanted}, {said}) THEN 0.5::DOUBLE
        ELSE 0::DOUBLE END"""


TABLES["scored"] = f"""
    SELECT prompt_id, completion_id, task_type,
        {_semantic('completion_embedding', 'reference_embedding', fixed.SIMILARITY_FLOOR,
                   fixed.SIMILARITY_SPAN)} AS semantic,
        {_language('completion', fixed.LANGUAGE_ALPHABET, fixed.LANGUAGE_DENSITY)} AS language,
        {_length('completion', 'output_improved')} AS length,
        {_accuracy('completion', 'output_improved', 'task_type')} AS accuracy
    FROM paired"""
TABLES["totals"] = (
    "SELECT *, "
    + " + ".join(f"{weight}::DOUBLE * {name}" for name, weight in fixed.REWARD_WEIGHTS.items())
    + " AS total FROM scored"
)

# The table expressions that each one reads.
READS = {
    "inst": ["turns"],
    "pairs": ["inst"],
    "responses": ["inst"],
    "latest": ["responses"],
    "answered": ["pairs", "latest"],
    "kept": ["answered"],
    "coded": ["kept"],
    "results": ["coded"],
    "improved": ["results"],
    "prepared": ["improved"],
    "labelled": ["inst"],
    "generated": ["improved"],
    "polish_coded": ["generated"],
    "polished": ["polish_coded"],
    "refs": ["inst"],
    "paired": ["refs"],
    "scored": ["paired"],
    "totals": ["scored"],
}


def _from(table: str, select: str) -> str:
    """``select`` with the table expressions it needs in front."""
    needed: set[str] = set()
    todo = [table]
    while todo:
        name = todo.pop()
        needed.add(name)
        todo.extend(READS.get(name, []))
    parts = [f"{name} AS ({body})" for name, body in TABLES.items() if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0::DOUBLE ELSE {part} * 100::DOUBLE / {whole} END"


def _rounded(names: list[str]) -> str:
    return ", ".join(f"round({name}, 6) AS {name}" for name in names)


def _rewritten(text: str, ref: str) -> str:
    """What the marking generator's answer to ``ref, blank line, text`` becomes."""
    response = f"(string_split({ref} || chr(10) || chr(10) || {text}, chr(10) || chr(10))[-1] || ' !')"
    result = _result(f"({_reason(response, text)})", response, text)
    return f"CASE WHEN {_skip(text, ref)} THEN {text} ELSE {result} END"


_ALL_REWRITTEN = ", ".join(
    f"{_rewritten(f'coalesce({t}, {_text("")})', f'coalesce({r}, {_text("")})')} AS {t}_improved"
    for t, r in fixed.COLUMN_PAIRS
)
REWARDS = list(fixed.REWARD_WEIGHTS)
_template = "|| ".join(
    {"{text}": "text", "{reference}": "ref_text"}.get(piece, _text(piece))
    for piece in REWRITE_TEMPLATE.replace("{text}", "\0{text}\0")
    .replace("{reference}", "\0{reference}\0")
    .split("\0")
    if piece
)
_user = f"""SELECT row_id, {{pos}}::INTEGER AS pos, 'user' AS role,
    {_content('instruction', 'input')} AS content FROM inst"""
_latest_all = "SELECT row_id, field, response, attempt FROM latest"
_changed = " UNION ALL ".join(
    f"""SELECT '{f}' AS field, count(*) FILTER ({f} IS DISTINCT FROM {f}_improved) AS changed,
    count(*) AS total, {_pct(f'count(*) FILTER ({f} IS DISTINCT FROM {f}_improved)', 'count(*)')} AS pct
    FROM improved"""
    for f in FIELDS
)
_report = f"""SELECT (SELECT count(*) FROM prepared) AS total_rows,
    (SELECT count(*) FROM prepared WHERE {_blank('content')}) AS empty_prompts,
    (SELECT string_agg(task_type || '=' || n, ',' ORDER BY task_type) FROM (
        SELECT task_type, count(*) AS n FROM prepared GROUP BY task_type)) AS task_types,
    '' AS missing,
    NOT EXISTS (SELECT 1 FROM prepared WHERE {_blank('content')}) AS is_valid"""
_near_copy = "'  ' || replace(text, 'e ', 'en ')"
_document_result = f"""
    SELECT doc_id, text, {_near_copy} AS response, {_reason(_near_copy, 'text')} AS reason FROM documents"""
_stream_rows = f"""
    SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN ' ' || chr(10) || text
        WHEN 1 THEN {_text(given.MARKER_HEAD)} || text
        WHEN 2 THEN {_text(given.SHORT_RESPONSE)} ELSE {_near_copy} END AS response
    FROM documents"""

ORACLES: dict[str, str] = {
    "instruction_scan": _from("inst", f"SELECT {SIX} FROM inst"),
    "stage_roundtrip": _from("improved", "SELECT * FROM improved"),
    "jsonl_roundtrip": _from("inst", f"SELECT {SIX} FROM inst"),
    "checkpoint_scan": _from("responses", "SELECT row_id, field, response, attempt FROM responses"),
    "checkpoint_salvage": _from(
        "responses", "SELECT row_id, field, response, attempt, 1::BIGINT AS quarantined FROM responses"
    ),
    "response_store_latest": _from("latest", _latest_all),
    "store_compacted": _from("latest", _latest_all),
    "ingest_dense_ids": _from(
        "inst",
        "SELECT row_id AS source_id, instruction, row_number() OVER (ORDER BY row_id) - 1 AS row_id, "
        "row_number() OVER (ORDER BY row_id) - 1 AS row_id_small FROM inst",
    ),
    "stage_versions": _from(
        "improved",
        "SELECT row_id, instruction AS text, 1 AS version FROM inst "
        "UNION ALL SELECT row_id, instruction_improved AS text, 2 AS version FROM improved",
    ),
    "subset_first_n": _from("inst", f"SELECT {SIX} FROM inst ORDER BY row_id LIMIT 100"),
    "subset_nth_key": _from(
        "inst", f"SELECT {SIX} FROM inst ORDER BY row_id LIMIT (SELECT count(*) // 2 FROM inst)"
    ),
    "field_pairs_unpivot": _from("pairs", "SELECT * FROM pairs"),
    "compare_preview": _from(
        "improved",
        "SELECT row_id, "
        + ", ".join(
            f"substring({c}, 1, 200) AS {c}"
            for c in ["instruction", "instruction_improved", "output", "output_improved", "output_en"]
        )
        + " FROM improved ORDER BY row_id LIMIT 5",
    ),
    "distill_preview": _from(
        "polished",
        """SELECT row_id, substring(instruction_improved, 1, 120) AS instruction_improved,
        substring(output_improved, 1, 200) AS output_improved,
        substring(output_generated, 1, 200) AS output_generated,
        substring(output_polished, 1, 200) AS output_polished FROM polished ORDER BY row_id LIMIT 5""",
    ),
    "skip_predicate": _from(
        "pairs", f"SELECT row_id, field, {_skip('text', 'ref_text')} AS skipped FROM pairs"
    ),
    "skip_split_counts": _from(
        "pairs",
        f"""SELECT field, count(*) FILTER ({_skip('text', 'ref_text')}) AS skipped,
        count(*) FILTER (NOT {_skip('text', 'ref_text')}) AS to_generate FROM pairs GROUP BY field""",
    ),
    "rewrite_prompt": _from("pairs", f"SELECT row_id, field, {_template} AS prompt FROM pairs"),
    "chat_prompt": _from("inst", _user.format(pos=0)),
    "chat_prompt_system": _from(
        "inst",
        f"SELECT row_id, 0::INTEGER AS pos, 'system' AS role, {_text(SYSTEM_MESSAGE)} AS content FROM inst"
        " UNION ALL " + _user.format(pos=1),
    ),
    "resume_pending": _from(
        "answered",
        """SELECT p.* FROM pairs p WHERE NOT EXISTS (
        SELECT 1 FROM responses r WHERE r.row_id = p.row_id AND r.field = p.field
        AND r.response IS NOT NULL)""",
    ),
    "attach_responses": _from("answered", "SELECT row_id, field, response FROM answered"),
    "improve_replay": _from("results", "SELECT * FROM results"),
    "improved_wide": _from("improved", "SELECT * FROM improved"),
    "improved_gathered": _from("improved", "SELECT * FROM improved"),
    "generate_batches": _from(
        "pairs", f"SELECT row_id, field, {_rewritten('text', 'ref_text')} AS result FROM pairs"
    ),
    "generate_budgeted": _from(
        "pairs", f"SELECT row_id, field, {_rewritten('text', 'ref_text')} AS result FROM pairs"
    ),
    "generate_with_failures": _from(
        "pairs",
        f"""SELECT row_id, field,
            CASE WHEN {_skip('text', 'ref_text')} OR length(ref_text || chr(10) || chr(10) || text) % 7 = 0 THEN NULL
                 ELSE string_split(ref_text || chr(10) || chr(10) || text, chr(10) || chr(10))[-1] || ' !' END AS response,
            CASE WHEN NOT {_skip('text', 'ref_text')} AND length(ref_text || chr(10) || chr(10) || text) % 7 = 0
                 THEN 'ValueError: cannot answer a prompt of '
                      || length(ref_text || chr(10) || chr(10) || text) || ' characters' END AS error
            FROM pairs""",
    ),
    "improve_generated": _from(
        "inst",
        f"SELECT {SIX}, {_ALL_REWRITTEN} FROM inst",
    ),
    "standard_chain": _from(
        "inst",
        f"""SELECT *, 1::INTEGER AS messages, 'user' AS role,
            {_content('instruction_improved', 'input_improved')} AS content,
            {_task_type('instruction_en')} AS task_type
        FROM (SELECT {SIX}, {_ALL_REWRITTEN} FROM inst)""",
    ),
    "distilled_chain": _from(
        "inst",
        f"""SELECT * EXCLUDE (output_improved, output_polished),
            output_polished AS output_improved, output_improved AS output_improved_phase1,
            1::INTEGER AS messages, 'user' AS role,
            {_content('instruction_improved', 'input_improved')} AS content,
            {_task_type('instruction_en')} AS task_type
        FROM (
            SELECT *, {_rewritten("coalesce(output_generated, '')", "coalesce(instruction_en, '')")} AS output_polished
            FROM (
                SELECT *, {_content('instruction_improved', 'input_improved')} || ' svar' AS output_generated
                FROM (SELECT {SIX}, {_ALL_REWRITTEN} FROM inst)))""",
    ),
    "resume_changed_text": _from(
        "pairs",
        "SELECT row_id, field FROM pairs WHERE length(text) % 2 = 1 OR row_id % 3 = 0",
    ),
    "validate_response": _from(
        "answered",
        f"""SELECT row_id, field, reason, {_result('reason', 'response', 'text')} AS result
        FROM (SELECT *, {_reason('response', 'text')} AS reason FROM answered)""",
    ),
    "validate_documents": f"""SELECT doc_id, length(result) AS chars, md5(result) AS digest FROM (
        SELECT doc_id, {_result('reason', 'response', 'text')} AS result FROM ({_document_result}))""",
    "preamble_extract": _from(
        "answered",
        f"SELECT row_id, field, {_line('response')} AS line FROM answered WHERE {_marked('response')}",
    ),
    "word_overlap": _from(
        "answered",
        f"""SELECT row_id, field, {_overlap('response', 'text')} AS overlap
        FROM answered WHERE response IS NOT NULL""",
    ),
    "validation_reasons": _from(
        "answered",
        f"""SELECT reason, count(*) AS n FROM (SELECT {_reason('response', 'text')} AS reason
        FROM answered) GROUP BY reason""",
    ),
    "task_type": _from("inst", f"SELECT row_id, {_task_type('instruction_en')} AS task_type FROM inst"),
    "prepared_table": _from("prepared", "SELECT * FROM prepared"),
    "task_distribution": _from(
        "labelled", "SELECT task_type, count(*) AS n FROM labelled GROUP BY task_type"
    ),
    "task_distribution_pct": _from(
        "labelled",
        """SELECT task_type, count(*) AS n,
        count(*) * 100::DOUBLE / (SELECT count(*) FROM labelled) AS pct
        FROM labelled GROUP BY task_type""",
    ),
    "sample_per_task": _from(
        "labelled",
        """SELECT task_type, row_id, substring(content, 1, 120) AS sample FROM labelled
        QUALIFY row_number() OVER (PARTITION BY task_type ORDER BY row_id) = 1""",
    ),
    "validation_report": _from("prepared", _report),
    "publish_observed": _from(
        "prepared",
        f"SELECT r.*, (SELECT count(*) FROM prepared) AS published_rows, 1 AS version FROM ({_report}) AS r",
    ),
    "prepare_documents": f"""SELECT doc_id, {_task_type('text')} AS task_type,
        md5(text) AS digest FROM documents""",
    "documents_report": f"""WITH prepared AS (
        SELECT text AS content, {_task_type('text')} AS task_type FROM documents) {_report}""",
    "invalid_report": _from(
        "inst",
        f"""SELECT count(*) AS total_rows, count(*) FILTER (row_id % 3 = 0 AND {_blank('input')}
            OR row_id % 3 <> 0 AND {_blank('instruction')} AND {_blank('input')}) AS empty_prompts,
        (SELECT string_agg(task_type || '=' || n, ',' ORDER BY task_type) FROM (
            SELECT {_task_type('instruction_en')} AS task_type, count(*) AS n FROM inst GROUP BY 1)) AS task_types,
        'output_improved' AS missing, false AS is_valid FROM inst""",
    ),
    "change_stats": _from("improved", _changed),
    "polish_change_rate": _from(
        "polished",
        f"""SELECT changed, total, {_pct('changed', 'total')} AS pct FROM (
        SELECT count(*) FILTER (output_generated IS DISTINCT FROM output_polished) AS changed,
        count(*) AS total FROM polished)""",
    ),
    "distill_generate_replay": _from(
        "generated", "SELECT row_id, output_improved, output_generated FROM generated"
    ),
    "distill_polish_replay": _from(
        "polished", "SELECT row_id, output_generated, output_polished FROM polished"
    ),
    "reference_swap": _from(
        "polished",
        """SELECT row_id, output_polished AS output_improved,
        output_improved AS output_improved_phase1 FROM polished""",
    ),
    "distilled_prepared": _from(
        "polished",
        f"""SELECT * EXCLUDE (output_improved, output_polished),
        output_polished AS output_improved, output_improved AS output_improved_phase1,
        1::INTEGER AS messages, 'user' AS role,
        {_content('instruction_improved', 'input_improved')} AS content,
        {_task_type('instruction_en')} AS task_type FROM polished""",
    ),
    "completion_reference_join": _from(
        "paired",
        "SELECT prompt_id, completion_id, completion, output_improved, task_type FROM paired",
    ),
    "language_reward": f"""SELECT doc_id,
        {_language('text', fixed.LANGUAGE_ALPHABET, fixed.LANGUAGE_DENSITY)} AS language,
        {_language('text', DOCUMENT_ALPHABET, DOCUMENT_DENSITY)} AS language_document FROM documents""",
    "length_reward": _from("scored", "SELECT prompt_id, completion_id, length FROM scored"),
    "accuracy_reward": _from("scored", "SELECT prompt_id, completion_id, accuracy FROM scored"),
    "semantic_reward": f"""SELECT a.vec_id,
        round({_semantic('a.embedding', 'b.embedding', fixed.SIMILARITY_FLOOR,
                         fixed.SIMILARITY_SPAN)}, 6) AS semantic,
        round({_semantic('a.embedding', 'b.embedding', WIDE_FLOOR, WIDE_SPAN)}, 6) AS semantic_wide
        FROM embeddings a JOIN embeddings b
            ON b.vec_id = (a.vec_id + 1) % (SELECT count(*) FROM embeddings)""",
    "embed_rewards": _from(
        "paired",
        f"""SELECT prompt_id, completion_id, round({_semantic('ce', 're', fixed.SIMILARITY_FLOOR, fixed.SIMILARITY_SPAN)}, 6) AS semantic FROM (
            SELECT prompt_id, completion_id,
                list_transform(cv, lambda v: (v / coalesce(nullif(sqrt(list_sum(list_transform(cv, lambda w: w * w))), 0), 1))::FLOAT) AS ce,
                list_transform(rv, lambda v: (v / coalesce(nullif(sqrt(list_sum(list_transform(rv, lambda w: w * w))), 0), 1))::FLOAT) AS re
            FROM (SELECT prompt_id, completion_id,
                CASE WHEN completion IS NOT NULL THEN [{_counts('completion')}]::DOUBLE[] END AS cv,
                CASE WHEN output_improved IS NOT NULL THEN [{_counts('output_improved')}]::DOUBLE[] END AS rv
                FROM paired))""",
    ),
    "weighted_reward": _from(
        "totals", f"SELECT prompt_id, completion_id, {_rounded([*REWARDS, 'total'])} FROM totals"
    ),
    "group_advantage": _from(
        "totals",
        """SELECT prompt_id, completion_id,
        round(total - avg(total) OVER (PARTITION BY prompt_id), 6) AS advantage FROM totals""",
    ),
    "own_reward_scaled": _from(
        "paired",
        f"""SELECT prompt_id, completion_id, accuracy, brief, total, round(
            (total - avg(total) OVER (PARTITION BY prompt_id))
            / (stddev_pop(total) OVER (PARTITION BY prompt_id) + 0.0001::DOUBLE), 5) AS advantage
        FROM (SELECT *, 0.5::DOUBLE * accuracy + 0.5::DOUBLE * brief AS total FROM (
            SELECT prompt_id, completion_id, {_accuracy('said', 'output_improved', 'task_type')} AS accuracy,
                (length(said) < 300)::INTEGER::DOUBLE AS brief
            FROM (SELECT *, CASE WHEN completion_id % 4 = 0 THEN 'Svar: ' || output_improved
                ELSE completion END AS said FROM paired)))""",
    ),
    "reward_by_task": _from(
        "totals",
        "SELECT task_type, count(*) AS n, "
        + ", ".join(f"round(avg({name}), 6) AS avg_{name}" for name in [*REWARDS, "total"])
        + " FROM totals GROUP BY task_type",
    ),
    "incremental_upsert": """SELECT doc_id,
        md5(CASE WHEN doc_id % 5 = 0 THEN text || ' (edited)' ELSE text END) AS digest,
        CASE WHEN doc_id % 5 = 0 AND text IS NOT NULL THEN 2 ELSE 1 END AS processed_in
        FROM documents WHERE doc_id IS NOT NULL""",
    "group_reward": _from(
        "paired",
        """SELECT prompt_id, completion_id, round(
            (count(*) OVER (PARTITION BY prompt_id, label))::DOUBLE
            / (count(*) OVER (PARTITION BY prompt_id))::DOUBLE, 9) AS agreement
        FROM (
            SELECT prompt_id, completion_id, translate(list_filter(list_transform(
                string_split(coalesce(completion, ''), chr(10)), lambda l: trim(l, ' ' || chr(9) || chr(13))),
                lambda l: l <> '')[1], '""" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz" + """') AS label
            FROM paired)""",
    ),
    "incremental_validate": f"""SELECT doc_id, reason, md5({_result('reason', 'response', 'text')}) AS digest
        FROM (SELECT *, {_reason('response', 'text')} AS reason FROM ({_stream_rows}))""",
}
