"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Every prompt, stub reply and parsed value is rebuilt in SQL from the same fixed texts, so
the Spark result (computed through the Arrow model column) can be checked value by value.
"""

from __future__ import annotations

from .catalog import (CHAIN_ROUNDS, EVAL_STEPS, RECORD_BLOCK, FIRST_EXAMPLES, FLAGSHIP_ROUNDS, GEN_SEED, JOBS, MULTI_ROUNDS, MULTI_TURNS, PAIR_PROMPT, PAIR_SEED,
                      SAMPLE_ROUNDS, SLICE_LENGTH, SLICE_START, SPLIT_SEED, SPLIT_TEST_SIZE)
from .functions import prompts as P
from .functions import texts as X
from .operators.preference import PREFERENCE_SYSTEM_PROMPT, VERDICT_PATTERN
from .sources.tables import BENCHMARK_CATEGORIES

KIT = X.DEFAULT_KIT
N_SL, N_RL = len(KIT.principles), len(KIT.preferences)
EMPTY_MSGS = "[]::STRUCT(role VARCHAR, content VARCHAR)[]"


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def msg(role_sql: str, content_sql: str) -> str:
    return f"{{'role': {role_sql}, 'content': {content_sql}}}"


def msgs_lit(msgs) -> str:
    return "[" + ", ".join(msg(q(r), q(c)) for r, c in msgs) + "]" if msgs else EMPTY_MSGS


def s(x: str) -> str:
    return f"coalesce({x}, '')"


def stub(lst: str) -> str:
    return (f"md5(array_to_string(list_transform({lst}, lambda m: coalesce(m.role, '') || chr(30) || "
            f"coalesce(m.content, '')), chr(31)))")


def template(h: str) -> str:
    start, sep, end = P.CHATML
    return (f"array_to_string(list_transform(coalesce({h}, {EMPTY_MSGS}), lambda m: {q(start)} || "
            f"coalesce(m.role, '') || {q(sep)} || coalesce(m.content, '') || {q(end)}), '')")


def transcript(h: str) -> str:
    return (f"({q(X.TRANSCRIPT_HEADER)} || array_to_string(list_transform(coalesce({h}, {EMPTY_MSGS}), "
            f"lambda m: (CASE WHEN m.role = 'user' THEN {q(X.STUDENT_ROLE_NAME)} ELSE {q(X.TEACHER_ROLE_NAME)} END)"
            f" || ': ' || coalesce(m.content, '') || chr(10)), '') || chr(10) || {q(X.STUDENT_PROMPT)})")


def last_content(h: str) -> str:
    return f"coalesce(({h})[-1].content, '')"


def crit_q(qs: str, r: str, c: str) -> str:
    return (f"({q(X.QUESTION_LABEL)} || {s(qs)} || chr(10) || {q(X.INITIAL_RESPONSE_LABEL)} || {s(r)} || chr(10)"
            f" || {q(X.CRITIQUE_REQUEST_LABEL)} || {s(c)})")


def rev_q(qs: str, r: str, c: str, x: str, v: str) -> str:
    return (f"({crit_q(qs, r, c)} || chr(10) || {q(X.CRITIQUE_LABEL)} || {s(x)} || chr(10) || "
            f"{q(X.REVISION_REQUEST_LABEL)} || {s(v)})")


def critique_prompt(last: str, r: str, c: str) -> str:
    return f"list_concat({msgs_lit(P.worked_prefix(KIT.critique, P.CRITIQUE_LINES, 'critique', KIT))}, [{msg(q('user'), crit_q(last, r, c))}])"


def revision_prompt(last: str, r: str, c: str, x: str, v: str) -> str:
    return f"list_concat({msgs_lit(P.worked_prefix(KIT.revision, P.REVISION_LINES, 'revision', KIT))}, [{msg(q('user'), rev_q(last, r, c, x, v))}])"


def teacher_prompt(h: str) -> str:
    return f"list_concat([{msg(q('system'), q(KIT.teacher))}], coalesce({h}, {EMPTY_MSGS}))"


def student_prompt(h: str) -> str:
    return f"list_concat({msgs_lit(P.dialogue_prefix(KIT))}, [{msg(q('user'), transcript(h))}])"


def judge_user(prompt: str, response: str) -> str:
    return (f"({q(KIT.rubric + chr(10) + chr(10) + X.JUDGE_QUESTION_HEADER + chr(10))} || {s(prompt)} || "
            f"{q(chr(10) + chr(10) + X.JUDGE_RESPONSE_HEADER + chr(10))} || {s(response)} || "
            f"{q(chr(10) + chr(10) + KIT.closing)})")


def judge_prompt(prompt: str, response: str) -> str:
    return f"[{msg(q('system'), q(KIT.judge))}, {msg(q('user'), judge_user(prompt, response))}]"


def hex_int(h: str, start: int, length: int) -> str:
    return f"('0x' || substr({h}, {start}, {length}))::BIGINT"


def pick(n: int, seed, *keys: str) -> str:
    parts = ", ".join([q(str(seed))] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"({hex_int(f'md5(concat_ws(chr(58), {parts}))', 1, 8)} % {n})"


def sl_list() -> str:
    return "[" + ", ".join(f"{{'critique': {q(c)}, 'revision': {q(r)}}}" for c, r in KIT.principles) + "]"


def rl_list() -> str:
    return "[" + ", ".join(q(p) for p in KIT.preferences) + "]"


def content_id(t: str) -> str:
    return hex_int(f"md5({s(t)})", 1, 15)


def judge_stub(lst: str) -> str:
    h = stub(lst)
    return (f"(SELECT CASE WHEN {hex_int('hh', 9, 2)} % 4 = 0 THEN 'Assessment ' || hh || '. I would put this at '"
            f" || CAST(1 + {hex_int('hh', 1, 8)} % 10 AS VARCHAR) || ' overall.' ELSE 'Assessment ' || hh || '.' ||"
            f" chr(10) || 'SCORE: ' || CAST(1 + {hex_int('hh', 1, 8)} % 10 AS VARCHAR) END FROM (SELECT {h} AS hh))")


def echo_stub(lst: str) -> str:
    h = stub(lst)
    return (f"(SELECT CASE WHEN {hex_int('hh', 1, 1)} % 2 = 0 THEN coalesce(({lst})[-1].content, '') || chr(10) || ' '"
            f" || hh || ' ' ELSE hh END FROM (SELECT {h} AS hh))")


def verdict_stub(lst: str) -> str:
    h = stub(lst)
    return (f"(SELECT 'Reasoning ' || hh || '. Answer: ' || CASE WHEN {hex_int('hh', 1, 2)} % 2 = 0 THEN 'A' "
            f"ELSE 'B' END FROM (SELECT {h} AS hh))")


def strip_echo(raw: str, prompt: str) -> str:
    return (f"(CASE WHEN starts_with({raw}, {s(prompt)}) THEN regexp_replace(substr({raw}, length({s(prompt)}) + 1),"
            f" '^\\s+|\\s+$', '', 'g') ELSE {raw} END)")


# ---------------------------------------------------------------------------------
# The score patterns in RE2 form (no look-around). The texts carry no
# slash, so the slash guards are void; Java's word boundary is written out as
# "not a letter, decimal digit or underscore", and the last match is taken with a
# greedy prefix.
# ---------------------------------------------------------------------------------
TAG_SQL = r"(?i)SCORE:\s*([0-9]+(?:\.[0-9]+)?)"
FALLBACK_SQL = r"(?s)^.*(?:^|[^\pL\p{Nd}_])(10|[1-9])(?:[^\pL\p{Nd}_]|$)"
# ---------------------------------------------------------------------------------


def tier1(t: str) -> str:
    return f"TRY_CAST(list_extract(regexp_extract_all({s(t)}, {q(TAG_SQL)}, 1), -1) AS DOUBLE)"


def tier2(t: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({s(t)}, {q(FALLBACK_SQL)}, 1), '') AS DOUBLE)"


def score(t: str) -> str:
    return f"greatest(1.0, least(10.0, coalesce({tier1(t)}, {tier2(t)}, 5.0)))"


def score_source(t: str) -> str:
    return (f"(CASE WHEN {tier1(t)} IS NOT NULL THEN 'tag' WHEN {tier2(t)} IS NOT NULL THEN 'fallback' "
            f"ELSE 'default' END)")


def word_count(t: str) -> str:
    tr = f"regexp_replace({s(t)}, '^\\s+|\\s+$', '', 'g')"
    return f"(CASE WHEN {tr} = '' THEN 0 ELSE len(string_split_regex({tr}, '\\s+')) END)"


FIRST_256, LAST_256 = r"^(?:\s*\S+){256}", r"(?:\S+\s*){256}$"  # a run of words, from one end of a text


def digest(items: list[str]) -> str:
    if not items:
        return "md5('')"
    return "md5(" + " || chr(31) || ".join(s(i) for i in items) + ")"


def split_case(key: str, seed=SPLIT_SEED, frac=SPLIT_TEST_SIZE) -> str:
    return (f"CASE WHEN row_number() OVER (ORDER BY md5({q(str(seed) + ':')} || {key}), {key}) <= "
            f"ceil(CAST({frac} AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END")


HISTORY = ("SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages "
           "FROM conversations GROUP BY conv_id")
PAIRS = ("SELECT conv_id, turn, before AS prompt, text AS response FROM (SELECT conv_id, turn, role, coalesce(text, '') "
         "AS text, lag(role) OVER w AS before_role, coalesce(lag(text) OVER w, '') AS before FROM conversations WINDOW w AS "
         "(PARTITION BY conv_id ORDER BY turn)) WHERE role = 'assistant' AND before_role = 'user'")
LAST_PAIRS = f"SELECT * FROM ({PAIRS}) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"
CONV_QUESTIONS = ("SELECT conv_id AS question_id, arg_min(text, turn) AS text, 'general' AS category "
                  "FROM conversations WHERE role = 'user' GROUP BY conv_id")
DOC_QUESTIONS = "SELECT doc_id AS question_id, text, lang AS category FROM documents"
EXAMPLES = ("SELECT item_id AS ord, text AS prompt, "
            "[" + ", ".join(q(c) for c in BENCHMARK_CATEGORIES) + f"][item_id % {len(BENCHMARK_CATEGORIES)} + 1]"
            " AS category FROM benchmark")


# ---- generation (C1/C2) as a chain of CTEs -------------------------------------------------

def generation_ctes(source: str, turns: int, rounds: int, seed: int, keep: list[str] | None = None,
                    chain: bool = False) -> tuple[str, str]:
    """CTEs computing the generation; returns (WITH-body, final SELECT producing the preference rows)."""
    keep = keep or []
    ctes = [f"g0 AS (SELECT question_id, {', '.join(keep) + ', ' if keep else ''}{content_id('text')} AS "
            f"conversation_id, category, text AS q0 FROM ({source}))"]
    n = 0

    def add(expr_map: dict[str, str]):
        nonlocal n
        cols = ", ".join(f"{e} AS {a}" for a, e in expr_map.items())
        ctes.append(f"g{n + 1} AS (SELECT *, {cols} FROM g{n})")
        n += 1

    for t in range(turns):
        if t == 0:
            add({"q_0": "q0"})
            add({"h_0": f"[{msg(q('user'), 'q_0')}]"})
        else:
            add({f"sq_{t}": stub(student_prompt(f"ha_{t - 1}"))})
            add({f"q_{t}": f"CASE WHEN sq_{t} IS NULL OR sq_{t} = '' THEN {q(X.DEFAULT_STUDENT_RESPONSE)} "
                           f"ELSE sq_{t} END"})
            add({f"h_{t}": f"list_concat(ha_{t - 1}, [{msg(q('user'), f'q_{t}')}])"})
        add({f"i_{t}": stub(teacher_prompt(f"h_{t}"))})
        for r in range(rounds):
            base = f"v_{t}_{r - 1}" if chain and r > 0 else f"i_{t}"
            add({f"p_{t}_{r}": f"{sl_list()}[{pick(N_SL, seed, 'question_id', str(t), str(r))} + 1]"})
            add({f"c_{t}_{r}": stub(critique_prompt(last_content(f'h_{t}'), base, f'p_{t}_{r}.critique'))})
            add({f"v_{t}_{r}": stub(revision_prompt(last_content(f'h_{t}'), base, f'p_{t}_{r}.critique',
                                                    f'c_{t}_{r}', f'p_{t}_{r}.revision'))})
        chosen = f"v_{t}_{rounds - 1}" if rounds else "CAST(NULL AS VARCHAR)"
        add({f"ha_{t}": f"list_concat(h_{t}, [{msg(q('assistant'), chosen)}])"})
    selects = []
    for t in range(turns):
        chosen = f"v_{t}_{rounds - 1}" if rounds else "CAST(NULL AS VARCHAR)"
        selects.append(
            f"SELECT question_id, CAST({t} AS BIGINT) AS turn, conversation_id, category, q_{t} AS question, "
            f"CAST(len(ha_{t}) AS BIGINT) AS n_messages, md5({template(f'ha_{t}')}) AS messages_md5, "
            f"i_{t} AS initial_response, "
            f"{digest([f'p_{t}_{r}.critique' for r in range(rounds)])} AS critique_requests_md5, "
            f"{digest([f'c_{t}_{r}' for r in range(rounds)])} AS critiques_md5, "
            f"{digest([f'p_{t}_{r}.revision' for r in range(rounds)])} AS revision_requests_md5, "
            f"{digest([f'v_{t}_{r}' for r in range(rounds)])} AS revisions_md5, "
            f"CAST({rounds} AS BIGINT) AS n_revisions, {chosen} AS chosen, i_{t} AS rejected, "
            f"ha_{t} AS messages{''.join(', ' + k for k in keep)} FROM g{n}")
    return ",\n".join(ctes), " UNION ALL ".join(selects)


def _prefs_sql(source: str, turns: int, rounds: int, keep=None, chain: bool = False) -> str:
    ctes, final = generation_ctes(source, turns, rounds, GEN_SEED, keep, chain)
    return f"WITH {ctes}, prefs AS ({final})"


PREF_COLS = ("question_id, turn, conversation_id, category, question, n_messages, messages_md5, initial_response, "
             "critique_requests_md5, critiques_md5, revision_requests_md5, revisions_md5, n_revisions, chosen, "
             "rejected")


def _flagship() -> str:
    ctes = [f"lt AS (SELECT conv_id AS question_id, prompt, response AS initial_response FROM ({LAST_PAIRS}))"]
    prev = "lt"
    for r in range(FLAGSHIP_ROUNDS):
        ctes.append(f"r{r}p AS (SELECT *, {sl_list()}[{pick(N_SL, GEN_SEED, 'question_id', '0', str(r))} + 1] AS p{r} "
                    f"FROM {prev})")
        ctes.append(f"r{r}c AS (SELECT *, {stub(critique_prompt('prompt', 'initial_response', f'p{r}.critique'))} "
                    f"AS c{r} FROM r{r}p)")
        ctes.append(f"r{r}v AS (SELECT *, "
                    f"{stub(revision_prompt('prompt', 'initial_response', f'p{r}.critique', f'c{r}', f'p{r}.revision'))}"
                    f" AS v{r} FROM r{r}c)")
        prev = f"r{r}v"
    rr = range(FLAGSHIP_ROUNDS)
    return (f"WITH {', '.join(ctes)} SELECT question_id, prompt, v{FLAGSHIP_ROUNDS - 1} AS chosen, "
            f"initial_response AS rejected, {digest([f'p{r}.critique' for r in rr])} AS critique_requests_md5, "
            f"{digest([f'c{r}' for r in rr])} AS critiques_md5, {digest([f'v{r}' for r in rr])} AS revisions_md5, "
            f"{split_case('CAST(question_id AS VARCHAR)')} AS split FROM {prev}")


def _turn_critiques() -> str:
    p = f"{sl_list()}[{pick(N_SL, GEN_SEED, 'conv_id', 'turn', '0', '0')} + 1]"
    return (f"WITH p AS (SELECT *, {p} AS p0 FROM ({PAIRS})), c AS (SELECT *, "
            f"{stub(critique_prompt('prompt', 'response', 'p0.critique'))} AS c0 FROM p), v AS (SELECT *, "
            f"{stub(revision_prompt('prompt', 'response', 'p0.critique', 'c0', 'p0.revision'))} AS v0 FROM c) "
            f"SELECT conv_id, turn, prompt, v0 AS chosen, response AS rejected, "
            f"{digest(['p0.critique'])} AS critique_requests_md5, {digest(['c0'])} AS critiques_md5 FROM v")


def _step_answers() -> str:
    ctx = "list_concat([{'role': 'system', 'content': 'checkpoint ' || CAST(step AS VARCHAR)}], " \
          "[{'role': 'user', 'content': prompt}])"
    raw = echo_stub(ctx)
    return (f"SELECT step, ord, prompt, category, {strip_echo(raw, 'prompt')} AS response FROM ({EXAMPLES}), "
            f"(SELECT unnest([{', '.join(str(x) for x in EVAL_STEPS)}]) AS step)")


def _judged(answers: str) -> str:
    return (f"SELECT *, {score('judgment')} AS score FROM (SELECT *, {judge_stub(judge_prompt('prompt', 'response'))}"
            f" AS judgment FROM ({answers}))")


def _metrics(details: str) -> str:
    m = X.METRIC_PREFIX
    return (f"WITH d AS ({details}), o AS (SELECT step, avg(score) AS a, stddev_pop(score) AS sd, min(score) AS mn, "
            f"max(score) AS mx FROM d GROUP BY step) "
            f"SELECT CAST(step AS BIGINT) AS step, CAST(NULL AS VARCHAR) AS category, metric, round(value, 6) AS value "
            f"FROM (SELECT step, '{m}score' AS metric, a AS value FROM o UNION ALL SELECT step, '{m}std', sd FROM o "
            f"UNION ALL SELECT step, '{m}min', mn FROM o UNION ALL SELECT step, '{m}max', mx FROM o) "
            f"UNION ALL SELECT CAST(step AS BIGINT), category, '{m}' || category, round(avg(score), 6) FROM d "
            f"WHERE category IS NOT NULL AND category <> '' GROUP BY step, category")


def _pairs() -> str:
    lab = "SELECT d.doc_id, d.text, d.lang, l.quality FROM documents d JOIN labels l USING (doc_id)"
    order = f"md5('{PAIR_SEED}:' || CAST(doc_id AS VARCHAR)), doc_id"
    return (f"WITH lab AS ({lab}), g AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY {order}) AS rank, "
            f"doc_id AS chosen_id, text AS chosen FROM lab WHERE quality = 1), b AS (SELECT lang, row_number() OVER "
            f"(PARTITION BY lang ORDER BY {order}) AS rank, doc_id AS rejected_id, text AS rejected FROM lab WHERE "
            f"quality = 0), pairs AS (SELECT g.lang, g.rank, chosen_id, chosen, rejected_id, rejected, "
            f"{q(PAIR_PROMPT)} || g.lang AS prompt FROM g JOIN b USING (lang, rank))")


def reward(prompt: str, text: str) -> str:
    return f"({hex_int(f'md5({s(prompt)} || chr(31) || {s(text)})', 1, 8)} / 4294967296.0)"


def oracle_sql() -> dict[str, str]:
    h = f"({HISTORY})"
    texts = ("SELECT 'documents' AS src, doc_id AS id, CAST(NULL AS BIGINT) AS turn, text FROM documents UNION ALL "
             "SELECT 'conversations', conv_id, turn, text FROM conversations")
    o: dict[str, str] = {}
    o["critique_revise"] = _flagship()
    o["unanswered"] = (f"SELECT conv_id, count(*) AS n_messages, count(*) FILTER (role = 'user') AS n_user, count(*) FILTER "
                       f"(role = 'assistant') AS n_assistant FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM "
                       f"({PAIRS})) GROUP BY conv_id")
    o["turn_critiques"] = _turn_critiques()
    o["slice_questions"] = (f"SELECT question_id, text, category FROM ({DOC_QUESTIONS}) ORDER BY question_id "
                            f"LIMIT {SLICE_LENGTH} OFFSET {SLICE_START}")
    o["question_defaults"] = CONV_QUESTIONS
    o["conversation_ids"] = f"SELECT doc_id, {content_id('text')} AS conversation_id FROM documents"
    o["assemble_history"] = (f"SELECT conv_id, CAST(len(messages) AS BIGINT) AS n_messages, messages[1].role AS "
                             f"first_role, messages[-1].role AS last_role, md5({template('messages')}) AS "
                             f"template_md5 FROM {h}")
    o["history_snapshots"] = (
        "SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS position, "
        "CAST(len(snap) AS BIGINT) AS n_messages, md5(" + template("snap") + ") AS snapshot_md5 FROM (SELECT conv_id,"
        " turn, list({'role': role, 'content': text}) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED "
        "PRECEDING AND CURRENT ROW) AS snap FROM conversations)")
    o["teacher_prompt"] = (f"SELECT conv_id, CAST(len(tp) AS BIGINT) AS n_messages, md5({template('tp')}) AS prompt_md5"
                           f" FROM (SELECT conv_id, {teacher_prompt('messages')} AS tp FROM {h})")
    sl_pick = f"{sl_list()}[{pick(N_SL, GEN_SEED, 'conv_id')} + 1]"
    o["critique_prompt"] = (
        f"SELECT conv_id, CAST(len(cp) AS BIGINT) AS n_messages, cp[-1].content AS user_text, md5({template('cp')})"
        f" AS prompt_md5 FROM (SELECT conv_id, {critique_prompt('prompt', 'response', 'p.critique')} AS cp"
        f" FROM (SELECT *, {sl_pick} AS p FROM ({LAST_PAIRS})))")
    o["revision_prompt"] = (
        f"SELECT conv_id, CAST(len(rp) AS BIGINT) AS n_messages, rp[-1].content AS user_text, md5({template('rp')})"
        f" AS prompt_md5 FROM (SELECT conv_id, "
        f"{revision_prompt('prompt', 'response', 'p.critique', 'first_user', 'p.revision')} AS rp FROM "
        f"(SELECT lt.*, fu.text AS first_user, {sl_pick.replace('conv_id', 'lt.conv_id')} AS p FROM ({LAST_PAIRS}) lt"
        f" LEFT JOIN ({CONV_QUESTIONS}) fu ON fu.question_id = lt.conv_id))")
    o["student_prompt"] = (f"SELECT conv_id, {transcript('messages')} AS transcript, CAST(len(sp) AS BIGINT) AS "
                           f"n_messages, md5({template('sp')}) AS prompt_md5 FROM (SELECT *, "
                           f"{student_prompt('messages')} AS sp FROM {h})")
    o["sample_principle"] = (
        f"SELECT conv_id, CAST(r AS BIGINT) AS round, {pick(N_SL, GEN_SEED, 'conv_id', 'r')} AS sl_index, "
        f"{sl_list()}[{pick(N_SL, GEN_SEED, 'conv_id', 'r')} + 1].critique AS critique, "
        f"{sl_list()}[{pick(N_SL, GEN_SEED, 'conv_id', 'r')} + 1].revision AS revision, "
        f"{rl_list()}[{pick(N_RL, GEN_SEED, 'conv_id', 'r')} + 1] AS rl_principle "
        f"FROM (SELECT DISTINCT conv_id FROM conversations), (SELECT unnest(range(0, {SAMPLE_ROUNDS})) AS r)")
    reply = ("(CASE WHEN messages[-1].role = 'assistant' THEN coalesce(messages[-1].content, '') ELSE '' END)")
    o["reply_extract"] = (f"SELECT conv_id, {reply} AS reply, CASE WHEN {reply} = '' THEN "
                          f"{q(X.DEFAULT_STUDENT_RESPONSE)} ELSE {reply} END AS reply_or_default FROM {h}")
    o["generate_batch"] = f"SELECT conv_id, {stub(teacher_prompt('messages'))} AS reply FROM {h}"
    o["multi_turn"] = f"{_prefs_sql(CONV_QUESTIONS, MULTI_TURNS, MULTI_ROUNDS)} SELECT {PREF_COLS} FROM prefs"
    o["chained_rounds"] = f"{_prefs_sql(CONV_QUESTIONS, 1, CHAIN_ROUNDS, chain=True)} SELECT {PREF_COLS} FROM prefs"
    jobs_src = (f"SELECT question_id, text, category, CAST(floor((row_number() OVER (ORDER BY question_id) - 1) / "
                f"ceil(count(*) OVER () / {JOBS})) AS BIGINT) AS job_id FROM ({DOC_QUESTIONS})")
    o["generation_job"] = f"{_prefs_sql(jobs_src, 1, 1, ['job_id'])} SELECT {PREF_COLS}, job_id FROM prefs"
    o["generation_summary"] = ("SELECT count(*) AS datapoints, count(*) AS conversations, CAST(0 AS BIGINT) AS errors, "
                               "CAST(1 AS BIGINT) AS rounds_per_conversation FROM documents")
    merged = (f"SELECT doc_id AS question_id, CAST(0 AS BIGINT) AS turn, lang AS category, text AS chosen, "
              f"md5(text) AS rejected, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / "
              f"ceil(count(*) OVER () / {JOBS})) AS BIGINT) AS job_id FROM documents")
    o["merge_jobs"] = merged
    o["merge_summary"] = (f"SELECT CAST(run AS BIGINT) AS run, job_id, count(*) AS loaded, CAST(CASE WHEN run = 0 THEN count(*) "
                          f"ELSE 0 END AS BIGINT) AS written FROM ({merged}), (SELECT unnest([0, 1]) AS run) GROUP BY run, job_id")
    o["incremental_merge"] = merged
    o["incremental_merge_keys"] = merged
    o["split_exact"] = f"SELECT doc_id, {split_case('CAST(doc_id AS VARCHAR)')} AS split FROM documents"
    pv = _prefs_sql(CONV_QUESTIONS, 1, 1)
    key = "CAST(question_id AS VARCHAR) || chr(31) || CAST(turn AS VARCHAR)"
    o["sft_view"] = (f"{pv} SELECT {split_case(key)} AS split, md5({template('messages')}) AS text_md5, "
                     f"CAST(length({template('messages')}) AS BIGINT) AS n_chars FROM prefs")
    o["preference_view"] = (f"{pv} SELECT question_id, turn, question AS prompt, chosen, rejected, category, "
                            f"{split_case(key)} AS split FROM prefs")
    conv_jobs = (f"SELECT question_id, text, category, CAST(floor((row_number() OVER (ORDER BY question_id) - 1) / "
                 f"ceil(count(*) OVER () / {JOBS})) AS BIGINT) AS job_id FROM ({CONV_QUESTIONS})")
    o["published_view"] = (f"{_prefs_sql(conv_jobs, 2, 1, ['job_id'])} SELECT question_id, turn, job_id, question AS prompt, "
                           f"chosen, rejected, category, {split_case(key + ' || chr(31) || CAST(job_id AS VARCHAR)')} AS split "
                           f"FROM prefs")
    o["length_caps"] = (f"{pv} SELECT question_id, CAST({word_count('question')} AS BIGINT) AS prompt_words, "
                        f"CAST({word_count('chosen')} AS BIGINT) AS chosen_words, CAST({word_count('rejected')} AS "
                        f"BIGINT) AS rejected_words, ({word_count('question')} <= 256 AND {word_count('question')} + "
                        f"greatest({word_count('chosen')}, {word_count('rejected')}) <= 512) AS fits FROM prefs")
    o["token_counts"] = f"SELECT src, id, turn, CAST({word_count('text')} AS BIGINT) AS tokens FROM ({texts})"
    raw = echo_stub("[{'role': 'user', 'content': prompt}]")
    o["strip_echo"] = f"SELECT ord, raw, {strip_echo('raw', 'prompt')} AS response FROM (SELECT *, {raw} AS raw FROM ({EXAMPLES}))"
    ans = f"SELECT *, {strip_echo(raw, 'prompt')} AS response FROM ({EXAMPLES})"
    o["judge_prompt"] = (f"SELECT ord, CAST(2 AS BIGINT) AS n_messages, {judge_user('prompt', 'response')} AS "
                         f"user_text FROM ({ans})")
    o["extract_score"] = f"SELECT src, id, turn, {score('text')} AS score, {score_source('text')} AS score_source FROM ({texts})"
    o["judged_eval"] = _metrics(_judged(f"SELECT 0 AS step, * FROM ({ans})"))
    first = f"SELECT * FROM ({ans}) ORDER BY ord LIMIT {FIRST_EXAMPLES}"
    o["first_examples_eval"] = f"SELECT ord, prompt, category, response, judgment, score FROM ({_judged(first)})"
    o["service_judgments"] = (f"SELECT ord, prompt, category, response, judgment, CAST(NULL AS VARCHAR) AS judge_error, score "
                              f"FROM ({_judged(ans)})")
    asked = ", ".join(f"({i}, {q(p)}, {q(c)})" for i, (p, c) in enumerate(KIT.examples))
    split_words = "list_distinct(string_split_regex(lower({}), '[^\\p{{L}}]+'))"
    o["default_examples"] = (
        f"WITH ex AS (SELECT * FROM (VALUES {asked}) AS t(ord, prompt, category)), w AS (SELECT *, unnest("
        f"{split_words.format('prompt')}) AS word FROM ex), n AS (SELECT word, count(*) AS n FROM (SELECT unnest("
        f"{split_words.format('text')}) AS word FROM ({texts})) GROUP BY word) SELECT CAST(ord AS BIGINT) AS ord, prompt, category, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS uses FROM w LEFT JOIN n USING (word) WHERE length(word) > 3 GROUP BY ALL")
    o["eval_details"] = f"SELECT CAST(step AS BIGINT) AS step, ord, category, response, judgment, score FROM ({_judged(_step_answers())})"
    listed = ", ".join(f"md5(string_agg({c}, chr(31) ORDER BY ord)) AS {c}s_md5" for c in ("prompt", "response", "judgment"))
    o["eval_records"] = (f"SELECT CAST(step AS BIGINT) AS step, count(*) AS n, {listed}, string_agg(CAST(CAST(score AS INT) AS VARCHAR), "
                         f"',' ORDER BY ord) AS scores FROM ({_judged(_step_answers())}) GROUP BY step")
    numbered = f"SELECT *, (row_number() OVER (PARTITION BY step ORDER BY ord) - 1) // {RECORD_BLOCK} AS block FROM ({_judged(_step_answers())})"
    o["eval_record_blocks"] = (f"SELECT CAST(step AS BIGINT) AS step, CAST(block AS BIGINT) AS block, count(*) AS n, {listed}, "
                               f"string_agg(CAST(CAST(score AS INT) AS VARCHAR), ',' ORDER BY ord) AS scores FROM ({numbered}) GROUP BY step, block")
    o["eval_history"] = _metrics(_judged(_step_answers()))
    o["eval_stream"] = o["eval_history"]
    o["best_step"] = (
        f"WITH d AS ({_judged(_step_answers())}), o AS (SELECT step, avg(score) AS v FROM d GROUP BY step) "
        f"SELECT '{X.METRIC_PREFIX}score' AS metric, CAST(step AS BIGINT) AS best_step, round(v, 6) AS best_value, "
        f"CAST((SELECT count(*) FROM o) AS BIGINT) AS n_steps FROM o ORDER BY v DESC, step ASC LIMIT 1")
    o["pair_reward"] = (
        f"{_pairs()}, r AS (SELECT *, {reward('prompt', 'chosen')} AS rc, {reward('prompt', 'rejected')} AS rr FROM "
        f"pairs) SELECT lang, CAST(rank AS BIGINT) AS rank, chosen_id, rejected_id, round(rc, 6) AS reward_chosen, "
        f"round(rr, 6) AS reward_rejected, round(rc - rr, 6) AS margin, (rc - rr) > 0 AS correct FROM r")
    o["reward_accuracy"] = (
        f"{_pairs()}, r AS (SELECT *, {reward('prompt', 'chosen')} - {reward('prompt', 'rejected')} AS margin FROM "
        f"pairs) SELECT lang, CAST(count(*) AS BIGINT) AS n_pairs, round(avg(CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 "
        f"END), 6) AS accuracy, round(avg(margin), 6) AS mean_margin FROM r GROUP BY lang")
    o["truncated_pairs"] = (
        f"{_pairs()}, t AS (SELECT lang, rank, chosen_id, rejected_id, prompt || chr(10) || chr(10) || coalesce(rejected, '') AS p, "
        f"coalesce(chosen, '') AS c, coalesce(rejected, '') AS r FROM pairs), n AS (SELECT *, {word_count('p')} AS np, "
        f"{word_count('c')} AS nc, {word_count('r')} AS nr FROM t), k AS (SELECT *, CASE WHEN np + greatest(nc, nr) > 512 THEN "
        f"least(np, 256) ELSE np END AS kp FROM n), f AS (SELECT *, CASE WHEN kp + nc > 512 THEN least(nc, 256) ELSE nc END AS kc, "
        f"CASE WHEN kp + nr > 512 THEN least(nr, 256) ELSE nr END AS kr FROM k) SELECT lang, CAST(rank AS BIGINT) AS rank, "
        f"chosen_id, rejected_id, CASE WHEN kp < np THEN regexp_extract(p, {q(LAST_256)}) ELSE p END AS prompt, "
        f"CASE WHEN kc < nc THEN regexp_extract(c, {q(FIRST_256)}) ELSE c END AS chosen, CASE WHEN kr < nr THEN "
        f"regexp_extract(r, {q(FIRST_256)}) ELSE r END AS rejected, CAST(kp + greatest(kc, kr) AS BIGINT) AS n_tokens, "
        f"kp < np OR kc < nc OR kr < nr AS cut FROM f")
    o["group_advantage"] = (
        f"WITH d AS (SELECT doc_id, source, {reward('source', 'text')} AS reward FROM documents), st AS (SELECT source,"
        f" avg(reward) AS m, coalesce(stddev_samp(reward), 0.0) AS sd, count(*) AS n FROM d GROUP BY source) "
        f"SELECT doc_id, source, round(reward, 6) AS reward, round(m, 6) AS group_mean, round(sd, 6) AS group_std, "
        f"CAST(n AS BIGINT) AS group_size, round((reward - m) / (sd + 0.0001), 6) AS advantage FROM d JOIN st "
        f"USING (source)")
    a = "CASE WHEN swapped THEN rejected ELSE chosen END"
    b = "CASE WHEN swapped THEN chosen ELSE rejected END"
    user = (f"principle || {q(chr(10) + chr(10) + 'QUESTION:' + chr(10))} || {s('prompt')} || {q(chr(10) + chr(10) + '(A) ')}"
            f" || {s(a)} || {q(chr(10) + chr(10) + '(B) ')} || {s(b)} || "
            f"{q(chr(10) + chr(10) + 'End with ' + chr(39) + 'Answer: A' + chr(39) + ' or ' + chr(39) + 'Answer: B' + chr(39) + '.')}")
    pp = f"[{msg(q('system'), q(PREFERENCE_SYSTEM_PROMPT))}, {msg(q('user'), user)}]"
    pk = f"upper(list_extract(regexp_extract_all(verdict, {q(VERDICT_PATTERN)}, 1), -1))"
    o["principle_preference"] = (
        f"{_pairs()}, p AS (SELECT *, {rl_list()}[{pick(N_RL, GEN_SEED, 'chosen_id', 'rejected_id')} + 1] AS principle, "
        f"{pick(2, f'{GEN_SEED}:order', 'chosen_id', 'rejected_id')} = 1 AS swapped FROM pairs), v AS (SELECT *, "
        f"{verdict_stub(pp)} AS verdict FROM p) SELECT lang, CAST(rank AS BIGINT) AS rank, chosen_id, rejected_id, "
        f"principle, swapped, verdict, CASE WHEN {pk} = 'A' THEN (CASE WHEN swapped THEN 'rejected' ELSE 'chosen' END) "
        f"WHEN {pk} = 'B' THEN (CASE WHEN swapped THEN 'chosen' ELSE 'rejected' END) END AS preferred FROM v")
    return o
