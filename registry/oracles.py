"""The same results as DuckDB SQL on the given tables, one statement per query."""

from __future__ import annotations

from finetide.operators import evaluation, generation

WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def norm(c: str) -> str:
    return f"regexp_replace({strip(f'lower({c})')}, '{WS}+', ' ', 'g')"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}+'), lambda x: x <> '')"


def quality(w: str) -> str:
    return (
        f"case when len({w}) = 0 then 0.0::double when len({w}) < 3 then 0.2::double "
        f"else least(1.0::double, 0.5::double + len(list_distinct({w}))::double / len({w}) * 0.5::double) end"
    )


def passes(c: str, low: int, high: int, score: float) -> str:
    return f"(length({c}) between {low} and {high} and ({quality(words(c))}) >= {score}::double)"


def validation_count(n: str, ratio: float) -> str:
    return (
        f"case when {n} <= 1 then 0 else least(greatest(1, "
        f"round_even({n} * (1 - {ratio}::double), 0)), {n} - 1) end"
    )


def split(source: str, id_col: str, columns: str, ratio: float = 0.9, seed: int = 42) -> str:
    rank = f"row_number() over (order by sha256('{seed}:' || {id_col}::varchar), {id_col})"
    return (
        f"select {columns}, case when _rank <= {validation_count('_n', ratio)} then 'validation' else 'train' end as split "
        f"from (select *, {rank} as _rank, count(*) over () as _n from ({source}))"
    )


def fingerprint(source: str, columns: list[str]) -> str:
    cells = [
        f"coalesce(length({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in sorted(columns)
    ]
    return f"""
        with h as (select sha256(concat_ws('|', {", ".join(cells)})) as h from ({source})),
        s as (select count(*) as n, coalesce(sum(('0x' || substr(h, 1, 15))::bigint), 0) as low,
                     coalesce(sum(('0x' || substr(h, 16, 15))::bigint), 0) as high from h)
        select n as n_rows, substr(sha256(concat_ws(':', n::varchar, low::varchar, high::varchar)), 1, 16) as fingerprint
        from s"""


DOCS = "select doc_id, text from documents"
PAIR = """
    select u.conv_id * 1000 + u.turn as row_id, u.text as prompt, a.text as response
    from conversations u join conversations a
      on a.conv_id = u.conv_id and a.turn = u.turn + 1 and u.role = 'user' and a.role = 'assistant'"""
PREFERENCE = f"""
    select p.row_id, p.prompt, p.response as chosen, r.text as rejected
    from ({PAIR}) p join conversations r on r.conv_id * 1000 + r.turn - 3 = p.row_id and r.role = 'assistant'"""
LOWER = "abcdefghijklmnopqrstuvwxyz"


def disguised(c: str) -> str:
    return f"'  ' || replace(translate({c}, '{LOWER}{LOWER.upper()}', '{LOWER.upper()}{LOWER}'), ' ', '   ') || chr(10)"


PAIRS = f"""
    select * from ({PAIR}) union all
    select row_id + 1000000000, {disguised('prompt')}, {disguised('response')} from ({PAIR})"""
PREFERENCES = f"""
    select * from ({PREFERENCE}) union all
    select row_id + 1000000000, {disguised('prompt')}, rejected, chosen from ({PREFERENCE})"""
SHORT = f"""
    with c as (select c_custkey::bigint as c_custkey, c_name || ' ' || c_mktsegment as text from customer)
    select * from c union all select c_custkey + 1000000000, {disguised('text')} from c"""
OUTPUTS = """
    select conv_id * 1000 + turn as id,
           case when (conv_id * 1000 + turn) % 3 = 0 then 'Response: ' || text else text end as output
    from conversations where role = 'assistant'"""
SEEDS = "select row_number() over (order by item_id) - 1 as idx, text as seed from benchmark"
REQUESTS = f"""
    select i as id, seed from (select unnest(range((select count(*) from documents))) as i)
    join ({SEEDS}) on idx = i % (select count(*) from benchmark)"""
ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
RUNS = f"""
    select 'run-' || o_orderkey as run_id, 'customer-' || o_custkey as run_name,
           case o_orderstatus when 'F' then 'completed' when 'O' then 'training' else 'failed' end as status,
           strftime(o_orderdate, {ISO}) as created_at,
           '{{"priority": "' || o_orderpriority || '", "method": "sft", "data": {{"train_split": 0.9, "seed": '
             || o_custkey || '}}}}' as config,
           case when o_orderstatus = 'F' then 'outputs/run-' || o_orderkey || '/final' end as checkpoint_path
    from orders"""


def kept(source: str, id_col: str, texts: list[str], key: str, low: int = 10, high: int = 4096, score: float = 0.0) -> str:
    """Rows that pass the filter and come first among equal texts."""
    test = " and ".join(passes(t, low, high, score) for t in texts)
    return f"""
        select * from ({source}) where {id_col} in (
            select min({id_col}) from ({source}) where {test} group by sha256({norm(key)}))"""


def near_kept(source: str, threshold: float) -> str:
    """The least id of each group of texts linked by all pairs of similar shingle sets."""
    shingle = "list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))"
    return f"""
        with recursive w as (select doc_id, {words(norm('text'))} as w from ({source})),
        g as (select doc_id, list_distinct({shingle}) as g from w),
        x as (select doc_id, len(g) as n, unnest(g) as s from g),
        p as (select a.doc_id as a, b.doc_id as b from x a join x b on a.s = b.s and a.doc_id <> b.doc_id
              group by a.doc_id, b.doc_id, a.n, b.n having count(*) / (a.n + b.n - count(*))::double >= {threshold}::double),
        r as (select doc_id as a, doc_id as b from w union select r.a, p.b from r join p on r.b = p.a)
        select a as doc_id from r group by a having min(b) = a"""


SFT_KEPT = kept(DOCS, "doc_id", ["text"], "text")
MERGED = f"select row_id, prompt || chr(10) || response as text from ({PAIR})"
MERGED_PAIRS = f"select row_id, prompt || chr(10) || response as text from ({PAIRS})"
NEAR_SOURCE = "select doc_id, text from documents where length(text) between 20 and 20000"
SFT_SPLIT = split(SFT_KEPT, "doc_id", "doc_id, text")
SINGLE = f"""
    select id, 'Instruction: ' || sha256(p) || chr(10) || 'Response: ok' as text, length(p) as tokens
    from (select id, seed || {lit(generation.REQUEST_SUFFIX)} as p from ({REQUESTS}))"""


def stub_answer(prompt: str) -> str:
    """What is left of the stub model's answer once it is stripped."""
    return f"case when sha256({prompt}) like '0%' then repeat(sha256({prompt}), 80) else sha256({prompt}) end"


def raw_answer(prompt: str) -> str:
    return (
        f"case when sha256({prompt}) like '0%' then ' ' || repeat(sha256({prompt}), 80) || ' ' "
        f"else ' ' || sha256({prompt}) || chr(10) end"
    )


TWO_STAGE = f"""
    with i as (select id, {raw_answer('seed')} as instruction from ({REQUESTS})),
    r as (select id, instruction,
                 {lit(generation.ANSWER_PREFIX)} || instruction || {lit(generation.ANSWER_SUFFIX)} as p from i),
    t as (select id, 'Instruction: ' || {strip('instruction')} || chr(10) || 'Response: ' || {stub_answer('p')} as text from r)
    select id, text from t where length(text) between 20 and 4096"""


def sample(limit: int) -> str:
    return (
        f"select doc_id, text from documents where {strip('text')} <> '' "
        f"order by sha256('42:' || doc_id::varchar), doc_id limit {limit}"
    )


def perplexity(source: str) -> str:
    return f"""
        with s as (select (length(text) % 97) / 20.0::double as loss, len({words('text')}) as n from ({source})),
        a as (select sum(loss * (n - 1)) / greatest(sum(n - 1), 1) as avg_loss from s where n >= 2)
        select round(exp(avg_loss), 6) as perplexity, round(avg_loss, 6) as avg_loss from a"""


ORACLES: dict[str, str] = {
    "preprocess_sft": SFT_SPLIT,
    "preprocess_sft_strict": split(
        kept(DOCS, "doc_id", ["text"], "text", 200, 3000, 0.9), "doc_id", "doc_id", 0.8, 7
    ),
    "preprocess_dpo": split(
        kept(PREFERENCES, "row_id", ["prompt", "chosen", "rejected"], "prompt", 60, 1600),
        "row_id",
        "row_id, prompt, chosen, rejected",
    ),
    "preprocess_pairs": split(kept(MERGED_PAIRS, "row_id", ["text"], "text", 60, 1600), "row_id", "row_id, text"),
    "preprocess_files": split(SFT_KEPT, "doc_id", "doc_id"),
    "preprocess_short_rows": split(
        kept(SHORT, "c_custkey", ["text"], "text", 28),
        "c_custkey",
        "c_custkey, text",
    ),
    "normalize_sft": DOCS,
    "normalize_sft_merge": MERGED,
    "normalize_dpo": PREFERENCE,
    "normalize_text": f"select doc_id, {norm('text')} as normalized, len({words('text')})::integer as n_words from documents",
    "rename_columns": f"select row_id, prompt as question, response as answer from ({PAIR})",
    "map_rows": f"select doc_id, len({words('text')})::integer as n_words, sha256(text) as digest from documents",
    "map_rows_callable": "select doc_id, length(text) as n_code_points from documents",
    "map_rows_arrow": "select vec_id, len(embedding)::bigint as n, embedding[1]::double as head, embedding[len(embedding)]::double as tail from embeddings",
    "filter_rows_arrow": "select doc_id from documents where regexp_matches(text, '[0-9]')",
    "filter_rows": "select doc_id, source, n_chars from documents where lang = 'en'",
    "filter_rows_callable": "select doc_id from documents where regexp_matches(text, '[0-9]')",
    "filter_length": "select doc_id from documents where length(text) between 10 and 4096",
    "filter_quality": f"select * from (select doc_id, {quality(words('text'))} as score from documents) where score >= 0.75",
    "filter_sft": f"select doc_id from documents where {passes('text', 200, 3000, 0.9)}",
    "filter_dpo": f"select row_id from ({PREFERENCE}) where "
    + " and ".join(passes(c, 60, 4096, 0.6) for c in ("prompt", "chosen", "rejected")),
    "dedup_text": f"{DOCS} where doc_id in (select min(doc_id) from documents group by sha256({norm('text')}))",
    "dedup_approx": near_kept(DOCS, 0.8),
    "preprocess_near": split(near_kept(NEAR_SOURCE, 0.85), "doc_id", "doc_id"),
    "dedup_prompt": f"""select row_id, prompt from ({PREFERENCES}) where row_id in
        (select min(row_id) from ({PREFERENCES}) group by sha256({norm('prompt')}))""",
    "row_position": "select doc_id, lang, row_number() over (order by doc_id) - 1 as position from documents",
    "batch_assign": """select doc_id, position, floor(position / 256)::bigint as batch
        from (select doc_id, row_number() over (order by doc_id) - 1 as position from documents)""",
    "select_positions": """
        with p as (select doc_id, n_chars, row_number() over (order by doc_id) - 1 as position from documents),
        l as (select doc_id as ordinal, case when quality = 1 then doc_id
                else (select count(*) from documents) - 1 - doc_id end as position from labels)
        select ordinal, doc_id, n_chars from l join p using (position)""",
    "select_indexed": """with p as (select event_id, user_id, row_number() over (order by event_id) - 1 as at_row, count(*) over () as n from events),
        o as (select o_orderkey, o_orderstatus, o_orderkey::bigint % (select count(*) from events) as place from orders)
        select o_orderkey, event_id, user_id from o join p on at_row = case when o_orderstatus = 'F' then n - 1 - place else place end""",
    "capped_scan": "select event_id, user_id, event_type from events order by event_id limit 5000",
    "eval_sample": sample(32),
    "eval_sample_large": """select event_id, props as text from events
        order by sha256('42:' || event_id::varchar), event_id limit 4000""",
    "split_exact": split("select doc_id, lang from documents", "doc_id", "doc_id, lang"),
    "split_exact_orders": split("select o_orderkey from orders", "o_orderkey", "o_orderkey", 0.75, 1),
    "split_semi_anti": """select doc_id, case when doc_id in (select doc_id from labels) then 'validation'
        else 'train' end as split from documents""",
    "split_stats": f"select split, count(*) as num_rows, 'doc_id,text' as columns from ({SFT_SPLIT}) group by split",
    "content_fingerprint": fingerprint("select * from documents", ["doc_id", "text", "lang", "source", "n_chars"]),
    "content_fingerprint_splits": fingerprint(SFT_SPLIT, ["doc_id", "text", "split"]),
    "scan_parquet": "select * from documents",
    "scan_jsonl": "select * from documents",
    "scan_csv": "select doc_id::varchar as doc_id, text, lang, source, n_chars::varchar as n_chars from documents",
    "scan_first_candidate": DOCS,
    "scan_seed_prompts": f"""select row_number() over (order by item_id) - 1 as idx, seed from
        (select item_id, {strip("replace(replace(text, chr(13), ' '), chr(10), ' ')")} as seed from benchmark)
        where seed <> ''""",
    "jsonl_roundtrip": "select doc_id, quality::bigint as quality, text from documents left join labels using (doc_id)",
    "from_columns": """select vec_id, (position - 1)::integer as position, embedding[position]::double as component,
        embedding[position]::double * embedding[position]::double as square
        from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as position from embeddings)""",
    "from_records_first_row_schema": """
        with d as (select doc_id, lang, case when doc_id % 3 = 1 then n_chars / 2.0::double else n_chars::double end as wide,
                          case when doc_id % 3 = 1 then (n_chars / 2.0::double)::varchar else n_chars::varchar end as printed
                   from documents)
        select doc_id, wide, case when doc_id % 5 = 2 then lang else printed end as kinds from d""",
    "count_parquet": "select count(*) as n_rows from lineitem",
    "count_jsonl": "select count(*) as n_rows from documents",
    "count_csv": "select count(*) as n_rows from documents",
    "cache_roundtrip": SFT_SPLIT,
    "prepare_cached": f"select doc_id, lang, split from ({split(kept('select * from documents', 'doc_id', ['text'], 'text'), 'doc_id', '*')})",
    "prepare_refreshed": f"select doc_id, lang, split from ({split(kept('select * from documents', 'doc_id', ['text'], 'text'), 'doc_id', '*')})",
    "prepare_appended": f"select doc_id, lang, split from ({split(kept('select * from documents', 'doc_id', ['text'], 'text'), 'doc_id', '*')})",
    "trainer_export": f"select {strip('text')} as text, split from ({SFT_SPLIT}) where {strip('text')} <> ''",
    "trainer_export_ordered": f"""select row_number() over (partition by split order by doc_id) - 1 as line, {strip('text')} as text, split
        from ({SFT_SPLIT}) where {strip('text')} <> ''""",
    "columnar_handoff": SFT_SPLIT,
    "cache_key": """select source, lang, substr(sha256('{"dataset":{"format":"jsonl","path":"' || source || '/' || lang
        || '.jsonl"},"method":"sft","train_split":0.9}'), 1, 16) as cache_key
        from (select distinct source, lang from documents)""",
    "plan_estimate": """
        with n as (select count(*) as n from documents), e as (select n, greatest(1, n // 8) as spe from n)
        select n as data_samples, spe as steps_per_epoch, spe * 3 as estimated_steps,
               round(spe * 3 * 0.001::double * 2, 3) as estimated_gpu_hours,
               round(n * 0.5::double + 500, 1) as estimated_disk_mb,
               round(greatest(n, 1) * 0.0001::double, 2) as estimated_preprocess_seconds,
               false as data_cache_hit from e""",
    "seed_round_robin": REQUESTS,
    "prompt_templates": f"""select row_id, prompt || {lit(generation.REQUEST_SUFFIX)} as request,
        {lit(generation.ANSWER_PREFIX)} || prompt || {lit(generation.ANSWER_SUFFIX)} as answer,
        'Instruction: ' || {strip('prompt')} || chr(10) || 'Response: ' || {strip('response')} as record from ({PAIR})""",
    "generate_single": SINGLE,
    "generate_two_stage": TWO_STAGE,
    "generation_usage": f"select count(*) as n_samples, sum(tokens)::bigint as total_tokens from ({SINGLE})",
    "generation_cache": SINGLE,
    "synthetic_end_to_end": split(TWO_STAGE, "id", "id, text"),
    "eval_perplexity": perplexity(DOCS),
    "eval_generation_quality": f"""select round(avg(len({words('output')})), 6) as avg_output_length,
        count(*) as num_samples from ({OUTPUTS})""",
    "eval_instruction_following": f"""select id, contains(output, {lit(evaluation.RESPONSE_MARK)}) as passed,
        substr(output, 1, {evaluation.SAMPLE_CHARS}) as sample_output from ({OUTPUTS})""",
    "eval_suite": f"""
        with p as ({perplexity(sample(10))}),
        g as (select round(avg(len({words("(text || ' done')")})), 6) as v, count(*) as n from ({sample(5)}))
        select 'perplexity' as bench, 'perplexity' as metric, perplexity as value, null::varchar as error from p
        union all select 'perplexity', 'avg_loss', avg_loss, null from p
        union all select 'generation_quality', 'avg_output_length', v, null from g
        union all select 'generation_quality', 'num_samples', n::double, null from g
        union all select 'instruction_following', 'passed', 1.0::double, null
        union all select 'unheard_of', null, null, 'Unknown benchmark: unheard_of'""",
    "metrics_flatten": """
        with s as (select source, max(n_chars)::double as longest, count(*)::double as n,
                          max(case when n_chars > 4096 then 1.0::double else 0.0::double end) as has_long
                   from documents group by source)
        select source, 'length_longest' as name, longest as value from s
        union all select source, 'length_has_long', has_long from s
        union all select source, 'rows_n', n from s""",
    "metrics_merge": """
        with n as (select l_orderkey as k, count(*)::double as items, max(l_quantity) as quantity from lineitem group by 1)
        select 'run-' || o_orderkey as run_id, 'loss' as name, o_totalprice as value from orders
        union all select 'run-' || o_orderkey, 'eval_items', coalesce(items, 0.0) from orders left join n on k = o_orderkey
        union all select 'run-' || o_orderkey, 'eval_quantity', quantity from orders join n on k = o_orderkey""",
    "eval_run_metrics": f"""
        with p as ({perplexity(f"select text from documents where {strip('text')} <> ''")}),
        g as (select round(avg(len({words("(text || ' done')")})), 6) as v, count(*)::double as n
              from documents where {strip('text')} <> ''),
        e as (
            select 'eval_perplexity_perplexity' as name, perplexity as value from p
            union all select 'eval_perplexity_avg_loss', avg_loss from p
            union all select 'eval_generation_quality_avg_output_length', v from g
            union all select 'eval_generation_quality_num_samples', n from g)
        select 'run-' || o_orderkey as run_id, 'loss' as name, o_totalprice as value from orders
        union all select 'run-' || o_orderkey, 'eval_items', 0.0 from orders
        union all select 'run-7', name, value from e where exists (select 1 from orders where o_orderkey = 7)""",
    "rl_prompts": "select doc_id, substr(text, 1, 256) as prompt from documents",
    "reward_length": f"select id, least(1.0::double, len({words('output')}) / 50.0::double) as reward from ({OUTPUTS})",
    "reward_length_chat": f"select id, least(1.0::double, len({words('output')}) / 50.0::double) as reward from ({OUTPUTS})",
    "reward_callable": f"select id, (length(output) - length(replace(output, chr(10), '')))::double as reward from ({OUTPUTS})",
    "reward_arrow": f"select id, (length(output) - length(replace(output, chr(10), '')))::double as reward from ({OUTPUTS})",
    "tokenize_arrow": """select doc_id, least(strlen(text), 64)::integer as n_tokens, coalesce(list_sum(list_transform(
        range(1, least(strlen(text), 64) + 1), lambda i: ('0x' || substr(hex(encode(text)), (2 * i - 1)::bigint, 2))::integer)), 0)::integer as id_sum
        from documents""",
    "tokenize_truncate": f"""select doc_id, array_to_string(w, ' ') as tokens, len(w)::integer as n_tokens
        from (select doc_id, ({words('text')})[1:128] as w from documents)""",
    "tokenize_callable": """select doc_id, least(length(text), 64)::integer as n_tokens,
        list_sum(list_transform(range(1, least(length(text), 64) + 1), lambda i: ord(substr(text, i, 1))))::integer as id_sum
        from documents""",
    "runs_list": f"""select run_id, run_name, case status when 'training' then 'failed' else status end as status,
        created_at, config from ({RUNS})""",
    "runs_list_compacted": f"""select run_id, run_name, case status when 'training' then 'failed' else status end as status,
        created_at, config from ({RUNS})""",
    "run_ids": "select count(*) as n, count(*) as n_ids, count(*) as n_good, count(*) as n_now from orders",
    "runs_lookup": f"select run_id, run_name, status, created_at from ({RUNS}) where run_id = 'run-7'",
    "runs_latest_state": f"""
        with s as (
            select 'run-' || o_orderkey as run_id, 'pending' as status, strftime(o_orderdate, {ISO}) as updated_at,
                   0::bigint as global_step from orders
            union all
            select 'run-' || l_orderkey, case when l_returnflag = 'R' then 'failed'
                   when l_linestatus = 'F' then 'completed' else 'training' end,
                   strftime(l_shipdate, {ISO}), l_linenumber * 100 from lineitem)
        select run_id, status, updated_at, global_step from (
            select *, row_number() over (partition by run_id order by updated_at desc, global_step desc, status desc) as n
            from s) where n = 1""",
    "runs_update": f"""
        with u as (select 'run-' || l_orderkey as run_id, l_linenumber::bigint as n,
                          strftime(l_shipdate, '%Y-%m-%d') || 'T' || l_linenumber as changed from lineitem),
        last as (select * from (select *, row_number() over (partition by run_id order by changed desc) as k from u) where k = 1)
        select r.run_id, run_name, 'completed' as status, n * 100 as global_step, changed as updated_at, created_at,
               case when n % 2 = 0 then 'step-' || n end as checkpoint_path
        from ({RUNS}) r join last using (run_id)""",
    "latest_checkpoint": f"""
        with c as (select 'run-' || l_orderkey as run_id, (max(l_linenumber) * 100)::bigint as step from lineitem
                   where l_returnflag <> 'R' group by l_orderkey)
        select coalesce(r.run_id, c.run_id) as run_id, step,
               case when step is null then checkpoint_path
                    else 'outputs/' || c.run_id || '/checkpoints/checkpoint-' || step end as checkpoint
        from ({RUNS}) r full join c on r.run_id = c.run_id
        where step is not null or checkpoint_path is not null""",
    "config_drift": """
        with k as (select 'run-' || o_orderkey as run_id,
            '{"data":{"seed":' || o_custkey || ',"train_split":0.9},"method":"sft","priority":"' || o_orderpriority || '"}' as a,
            '{"data":{"seed":' || (o_custkey + 1) || ',"train_split":0.9},"method":"sft","priority":"' || o_orderpriority || '"}' as b
            from orders where o_orderstatus = 'F')
        select run_id, substr(sha256(a), 1, 16) as original_hash, substr(sha256(b), 1, 16) as new_hash from k""",
    "artifact_inventory": """select s_suppkey::bigint as s_suppkey, strlen(s_name) + 1 as size, sha256(s_name || chr(10)) as sha256,
        s_name || chr(10) as sample from supplier""",
    "artifact_listing": """select c_nationkey::bigint as c_nationkey, sum(strlen(c_custkey || ',' || c_name) + 1)::bigint as size
        from customer where c_nationkey::varchar like '1%' group by 1""",
    "artifact_pages": """select 'pages/' || page_id || '.html' as path, strlen(html) as size, sha256(html) as sha256,
        lower(hex(encode(html)))[1:1024] as sample from pages""",
    "artifact_modes": """
        select 'pages/' || page_id || '.html' as path, case when large then 'lfsFile' else 'file' end as key,
               case when large then 'lfs' else 'regular' end as mode,
               case when large then sha256(html) end as oid, case when large then strlen(html) end as size,
               case when not large then base64(encode(html)) end as content
        from (select *, contains(url, '/en/') as large from pages where contains(url, '/en/') or not contains(url, '/de/'))""",
    "artifact_parts": """
        with p as (select doc_id, source, unnest(range(1, ceil(n_chars / 1000)::bigint + 1)) as n from documents),
        s as (select doc_id, count(*)::integer as n_parts, string_agg(source || '/' || n, ' ' order by n) as parts
              from p group by doc_id)
        select doc_id, coalesce(n_parts, 0)::integer as n_parts, coalesce(parts, '') as parts
        from documents left join s using (doc_id)""",
    "stream_preprocess": f"select doc_id, text from documents where {passes('text', 10, 4096, 0.0)}",
    "stream_dedup": f"select distinct sha256({norm('text')}) as digest from documents where {passes('text', 10, 4096, 0.0)}",
    "stream_prepared": f"select distinct sha256({norm('text')}) as digest from documents where {passes('text', 10, 4096, 0.0)}",
    "stream_split": """select doc_id, case when ('0x' || substr(sha256('42:' || doc_id::varchar), 1, 8))::bigint / 4294967296.0::double
        < (1 - 0.9::double) then 'validation' else 'train' end as split from documents""",
    "stream_capped": "select least(600, count(*)) as n_rows, least(600, count(distinct doc_id)) as n_ids, least(600, count(*)) as n_members from documents",
    "stream_bounded": f"select distinct sha256({norm('props')}) as digest from events",
}
