"""The same queries as SQL for DuckDB over the given tables.

Doubles are compared rounded to 6 places. A nudge of 1e-9 on both sides keeps values that
lie half-way, to the last bit, from being rounded apart.
"""

from pricetide.plans.catalogue import SEARCHES
from pricetide.plans.driver_tables import WORDS
from pricetide.plans.search_report import RANK_ERROR
from pricetide.sources.synthetic import (
    COUNTRIES,
    DIGITS,
    HIGH_KEYS,
    LOW_KEYS,
    PRICE_BUCKETS,
    PRIME,
    Vocabulary,
)


def key_of(number, country="'US'"):
    return f"{country} || lpad(cast({number} as varchar), 9, '0') || cast({number} % 10 as varchar)"


def words_of(text):
    return (
        rf"regexp_extract_all(lower({text}), "
        r"'[\p{L}\p{M}\p{N}_]+(?:[''’.][\p{L}\p{M}\p{N}_]+)*')"
    )


def quoted(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


VIEWS = {
    "instruments": f"""select {key_of('p_partkey')} as isin, p_name as name,
        concat_ws(' ', p_brand, p_type, p_name) as long_name, p_retailprice as price from part""",
    "docs": f"""select doc_id, text, n_chars, {words_of('text')} as words from documents""",
    "changes": f"""select {key_of('l_partkey', "case when l_returnflag = 'R' then 'GB' else 'US' end")} as isin, l_extendedprice as price,
        l_shipdate as updated_at, l_orderkey as update_iteration, l_linenumber as line from lineitem""",
    "target": "select isin, name, long_name, price from instruments",
    "latest": """select * from (select *, row_number() over (partition by isin
            order by updated_at desc, update_iteration desc, line desc) as rn,
            count(*) over (partition by isin) as changes from changes) where rn = 1""",
    "replacements": f"""select {key_of('p_partkey', "case when p_type = 'PROMO' then 'GB' else 'US' end")} as isin,
        p_name as name, concat_ws(' ', p_brand, p_type, p_name) as long_name, p_retailprice * 2 as price from part""",
    "dirty": f"""select {key_of('p_partkey')} as isin, case when p_type <> 'SMALL' then p_name end as name,
            concat_ws(' ', p_brand, p_type, p_name) as long_name,
            case when p_type <> 'LARGE' then p_retailprice end as price, p_partkey * 2 as row_order from part
        union all
        select {key_of('p_partkey')}, p_name, concat_ws(' ', p_brand, p_type, p_name),
            p_retailprice + 1, p_partkey * 2 + 1 from part""",
    "first_copies": """select * from (select *, row_number() over (partition by isin
            order by row_order) as rn from dirty) where rn = 1""",
    "cleaned": """select isin, name, long_name, price from first_copies
        where name is not null and long_name is not null and price is not null""",
    "updates": """select ts as "timestamp", event_id as iteration,
            cast(200000 as bigint) as total_instruments,
            1000 * (1 + user_id % 150) as success_count, event_id % 3 as error_count,
            value as duration_seconds,
            case when value = 0 then 0.0 else 1000 * (1 + user_id % 150) / value end as updates_per_second
        from events where event_type = 'purchase'""",
    "searches": """select ts as "timestamp", event_id as search_id,
            event_type || '_' || cast(user_id % 3 as varchar) as search_type,
            event_type as query_type, event_id % 20 <> 0 as success, value as duration_ms,
            user_id as total_hits
        from events where event_type <> 'purchase'""",
    "good": "select * from searches where success",
    "measured": "select * from good where search_id % 7 <> 2",
    "measured_pairs": """select w.iteration, w."timestamp" as update_timestamp, s.duration_ms
        from windows w join measured s on s."timestamp" between w.window_start and w.window_end""",
    "measured_per_window": """select update_timestamp, iteration, count(*) as search_count,
            avg(duration_ms) as avg_search_duration from measured_pairs group by all""",
    "windows": """select *, "timestamp" as window_start,
            "timestamp" + to_microseconds(cast(round(duration_seconds * 1e6) as bigint)) as window_end
        from updates""",
    "end_windows": """select *, "timestamp" as window_end,
            "timestamp" - to_microseconds(cast(round(duration_seconds * 1e6) as bigint)) as window_start
        from updates""",
    "pairs": """select w.iteration, w."timestamp" as update_timestamp,
            w.duration_seconds as update_duration, w.updates_per_second, s.search_id, s.duration_ms
        from windows w join good s on s."timestamp" between w.window_start and w.window_end""",
    "end_pairs": """select w.iteration, w."timestamp" as update_timestamp,
            w.duration_seconds as update_duration, w.updates_per_second, s.search_id, s.duration_ms
        from end_windows w join good s on s."timestamp" between w.window_start and w.window_end""",
    "per_window": """select update_timestamp, iteration, update_duration, updates_per_second,
            count(*) as search_count, avg(duration_ms) as avg_search_duration
        from pairs group by all""",
    "outside": """select s.* from good s where not exists (select 1 from windows w
            where s."timestamp" between w.window_start and w.window_end)""",
    "ten_minutes": """select iteration, "timestamp" as window_start,
            "timestamp" + interval 10 minute as window_end from updates""",
    "turns": "select price, row_order % 97 as turn from dirty",
    "fences": """select query_type, quantile_cont(duration_ms, 0.25) as q1,
            quantile_cont(duration_ms, 0.5) as median, quantile_cont(duration_ms, 0.75) as q3
        from good group by query_type""",
    "fenced": """select g.query_type, g.duration_ms, q1, median, q3,
            g.duration_ms between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
        from good g join fences f on g.query_type = f.query_type""",
    "stats": "select min(price) as min_price, max(price) as max_price, round(avg(price) + 1e-9, 6) as avg_price from instruments",
}


def requests(kinds=("price_range", "text_search", "combined"), low=100, step=37, width=2000):
    """As the requests table: a search per supplier, with its words split up."""
    return f"""select query_id, search_type, kind as query_type,
            case when kind <> 'text_search' then low end as min_price,
            case when kind <> 'text_search' then low + 20 + query_id * 53 % {width} end as max_price,
            case when kind <> 'price_range' then terms end as terms,
            case when kind <> 'price_range' then {words_of('terms')} else [] end as asked
        from (select s_suppkey as query_id, kind, kind || '_' || cast(s_suppkey % 5 as varchar) as search_type,
                cast({low} + s_suppkey * {step} % {width} as double) as low,
                ({quoted(WORDS)})[s_suppkey % {len(WORDS)} + 1] as terms
            from (select s_suppkey, ({quoted(kinds)})[s_suppkey % {len(kinds)} + 1] as kind from supplier))"""


def with_views(sql, **extra):
    """Put the views a query names, and those they name, in front of it."""
    views = {**VIEWS, **extra}
    needed, queue = [], [sql]
    while queue:
        text = queue.pop()
        for name in views:
            if name not in needed and _mentions(text, name):
                needed.append(name)
                queue.append(views[name])
    if not needed:
        return sql
    ordered = [name for name in views if name in needed]
    # A view may only name views before it.
    placed, listed = [], []
    while ordered:
        for name in ordered:
            if not any(_mentions(views[name], other) for other in ordered if other != name):
                placed.append(f"{name} as ({views[name]})")
                listed.append(name)
                ordered.remove(name)
                break
    return "with " + ",\n".join(placed) + "\n" + sql


def _mentions(text, name):
    padded = text.replace("(", " ").replace(")", " ").replace(",", " ").replace("\n", " ").split()
    return any(
        word == name and before in ("from", "join") for before, word in zip(padded, padded[1:])
    )


REPLACED = """select isin, name, long_name, price, cast(null as timestamp) as updated_at,
        cast(7 as bigint) as update_iteration
    from target where isin not in (select isin from replacements)
    union all
    select isin, name, long_name, price, timestamp '2024-01-01 00:00:00', null from replacements"""

PATCHED = """select t.isin, t.name, t.long_name,
        round(case when c.isin is not null then c.price else t.price end + 1e-9, 6) as price,
        c.updated_at, c.update_iteration
    from target t left join latest c on t.isin = c.isin"""

ANY_WORDS = ["the", "hein"]


def relevance(where, columns):
    """BM25 of two words over the documents."""
    tf = [f"len(list_filter(words, lambda x: x = '{w}'))" for w in ANY_WORDS]
    score = " + ".join(
        f"ln(1 + (n - d{i} + 0.5) / (d{i} + 0.5)) * tf{i} / (tf{i} + 1.2 * (0.25 + 0.75 * dl / avgdl))"
        for i in range(2)
    )
    return f"""select {columns}, round({score} + 1e-9, 6) as score
        from (select doc_id, n_chars, len(words) as dl, {tf[0]} as tf0, {tf[1]} as tf1 from docs),
            (select count(*) as n, avg(len(words)) as avgdl, count_if({tf[0]} > 0) as d0,
                count_if({tf[1]} > 0) as d1 from docs)
        where tf0 + tf1 > 0 {where} order by score desc, doc_id limit 3"""


def all_words(words):
    return " and ".join(f"list_contains(words, '{w}')" for w in words)


MATCHED = """select q.query_id, i.{key} as {key}, cast(i.{price} as double) as price
    from requests q join {items} i on (q.min_price is null or i.{price} between q.min_price and q.max_price)
        and len(list_filter(q.asked, lambda w: not list_contains(i.words, w))) = 0"""
RANKED = """select query_id, cast(rank as integer) as rank, {key}, price
    from (select *, row_number() over (partition by query_id order by price, {key}) as rank from matched)
    where rank <= 100"""
COUNTED = """select q.query_id, count(m.query_id) as total_hits,
        least(count(m.query_id), 10000) as total_hits_capped,
        count(m.query_id) > 10000 as total_is_lower_bound,
        least(count(m.query_id), 100) as returned_hits
    from requests q left join matched m on q.query_id = m.query_id group by q.query_id"""
DOC_HITS = dict(key="doc_id", price="n_chars", items="docs")


def shortened(text):
    return f"case when length({text}) > 50 then substr({text}, 1, 50) || '...' else {text} end"


def correlation(x):
    c = f"corr({x}, avg_search_duration)"
    return f"case when isnan({c}) then null else {c} end"


LABEL = """case when abs(correlation) > 0.7 then 'Strong correlation'
    when abs(correlation) > 0.5 then 'Moderate correlation'
    when abs(correlation) > 0.3 then 'Weak correlation' else 'No significant correlation' end"""


def summary(column, table, deviation=False):
    extra = f", round(stddev_samp({column}) + 1e-9, 6) as stddev" if deviation else ""
    return f"""select round(avg({column}) + 1e-9, 6) as mean, round(min({column}) + 1e-9, 6) as min,
        round(max({column}) + 1e-9, 6) as max{extra}, round(median({column}) + 1e-9, 6) as median from {table}"""


def grouped(column):
    return f"""select {column}, round(avg(duration_ms) + 1e-9, 6) as mean, count(*) as count,
        round(median(duration_ms) + 1e-9, 6) as median from good group by {column}"""


def window_summary(pairs):
    return f"""select update_timestamp, iteration, round(update_duration + 1e-9, 6) as update_duration,
        round(updates_per_second + 1e-9, 6) as updates_per_second, count(*) as search_count,
        round(avg(duration_ms) + 1e-9, 6) as avg_search_duration,
        round(median(duration_ms) + 1e-9, 6) as median_search_duration,
        round(max(duration_ms) + 1e-9, 6) as max_search_duration
    from {pairs} group by all"""


def catalogue():
    rows = ", ".join(
        "({}, '{}', '{}', {}, {}, {})".format(
            i, name, kind, low or "null", high or "null", f"'{words}'" if words else "null"
        )
        for i, (name, kind, words, low, high) in enumerate(SEARCHES, 1)
    )
    return f"""select cast(query_id as bigint) as query_id, search_type, query_type,
            round(case when low >= high then high - 1 else low end, 2) as min_price,
            round(high, 2) as max_price, terms
        from (select query_id, search_type, query_type, terms,
                case when low is not null then greatest(low, min_price) end as low,
                case when high is not null then least(high, max_price) end as high
            from stats, lateral (values {rows}) as v(query_id, search_type, query_type, low, high, terms))"""


# Synthetic tables: the same integer arithmetic.


def scramble(i, salt):
    folded = f"(({i}) % {PRIME} + (({i}) // {PRIME}) * 16807) % {PRIME}"
    return f"((({folded}) * 48271 + {salt * 40692 + 11}) % {PRIME} * 69621 + {salt}) % {PRIME}"


def pick(i, salt, values):
    return f"({quoted(values)})[({scramble(i, salt)}) % {len(values)} + 1]"


def base36(number, places):
    return " || ".join(
        f"substr('{DIGITS}', cast((({number}) // {36**k}) % 36 as integer) + 1, 1)"
        for k in reversed(range(places))
    )


def filled(pattern, salt):
    names = list(Vocabulary.__dataclass_fields__)
    parts = []
    for piece in pattern.replace("{", "\0{").replace("}", "}\0").split("\0"):
        if piece.startswith("{"):
            name = piece[1:-1]
            place = names.index(name.rstrip("2"))
            values = getattr(Vocabulary(), name.rstrip("2"))
            parts.append(pick("i", salt + place + (10 if name.endswith("2") else 0), values))
        elif piece:
            parts.append(f"'{piece}'")
    return " || ".join(parts)


def one_of(patterns, salt):
    cases = " ".join(f"when {k} then {filled(p, salt)}" for k, p in enumerate(patterns))
    return f"case ({scramble('i', salt)}) % {len(patterns)} {cases} end"


def price_of(i, salt):
    cases = " ".join(
        f"when {k} then {low * 100} + ({scramble(i, salt + 1)}) % {(high - low) * 100 + 1}"
        for k, (low, high) in enumerate(PRICE_BUCKETS)
    )
    return f"(case ({scramble(i, salt)}) % {len(PRICE_BUCKETS)} {cases} end) / 100.0"


def synthetic(table, column):
    words = Vocabulary()
    n = len(words.closings)
    steps = f"select *, {one_of(words.long_patterns, 40)} as t0, ({scramble('i', 59)}) % {n} as start from keyed"
    for k in range(n):
        phrase = f"({quoted(words.closings)})[(start + {k}) % {n} + 1]"
        steps = f"select *, case when length(t{k}) < 100 then t{k} || ' ' || {phrase} else t{k} end as t{k + 1} from ({steps})"
    return f"""select {pick('i', 3, COUNTRIES)} || {base36('high', 5)} || {base36('low', 4)}
            || cast(({scramble('i', 4)}) % 10 as varchar) as isin,
            {one_of(words.name_patterns, 20)} as name,
            case when length(t{n}) > 200 then substr(t{n}, 1, 197) || '...' else t{n} end as long_name,
            {price_of('i', 60)} as price
        from ({steps})""", {
        "ids": f"select {column} as i, {column} % {LOW_KEYS} as low0, {column} // {LOW_KEYS} as high0 from {table}",
        "halved": f"select i, high0, (low0 * 485207 + ({scramble('high0', 1)})) % {LOW_KEYS} as low from ids",
        "keyed": f"select i, low, (high0 * 23456789 + ({scramble('low', 2)})) % {HIGH_KEYS} as high from halved",
    }


def synthetic_sql(table, column):
    sql, views = synthetic(table, column)
    return with_views(sql, **views)


def synthetic_profile(table, column):
    sql, views = synthetic(table, column)
    return with_views(
        """select count(*) as rows, round(min(price) + 1e-9, 6) as min_price, round(max(price) + 1e-9, 6) as max_price,
            round(avg(price) + 1e-9, 6) as avg_price, count(distinct substr(isin, 1, 2)) as countries from made""",
        made=sql,
        **views,
    )


KEY_NUMBER = " + ".join(
    f"(strpos('{DIGITS}', substr(isin, {3 + k}, 1)) - 1) * {36 ** (8 - k)}" for k in range(9)
)


def oracle_sql():
    doc_match = dict(requests=requests(), matched=MATCHED.format(**DOC_HITS))
    text_match = dict(requests=requests(("text_search",)), matched=MATCHED.format(**DOC_HITS))
    range_match = dict(
        requests=requests(("price_range",), 890, 7, 120),
        items="select *, ['x'] as words from instruments",
        matched=MATCHED.format(key="isin", price="price", items="items"),
    )
    twins = {
        "price_range_top100": "select * from instruments where price between 910 and 960 order by price, isin limit 100",
        "price_stats": "select round(min_price + 1e-9, 6) as min_price, round(max_price + 1e-9, 6) as max_price, round(avg_price + 1e-9, 6) as avg_price from stats",
        "text_all_terms": f"select doc_id, n_chars from docs where {all_words(['the', 'and'])} order by n_chars, doc_id limit 100",
        "text_any_term": f"select doc_id, n_chars from docs where list_has_any(words, {quoted(ANY_WORDS)}) order by n_chars, doc_id limit 100",
        "text_bm25_top3": relevance("", "doc_id"),
        "combined_search": f"select doc_id, n_chars from docs where {all_words(['the', 'and'])} and n_chars between 100 and 900 order by n_chars, doc_id limit 100",
        "combined_bm25_top3": relevance("and n_chars between 100 and 500", "doc_id, n_chars"),
        "long_text_filter": "select doc_id, n_chars from docs where length(text) > 150 order by doc_id limit 3",
        "long_text_count": "select count(*) as rows from docs where length(text) > 150",
        "length_stats": "select round(avg(length(text)) + 1e-9, 6) as avg_length, min(length(text)) as min_length, max(length(text)) as max_length from documents",
        "row_count": "select count(*) as rows from instruments",
        "key_projection": "select isin from instruments",
        "preview_rows": "select isin, name, long_name, round(price + 1e-9, 6) as price from instruments order by isin limit 10",
        "table_profile": """select count(*) as rows, round(min(price) + 1e-9, 6) as min_price,
            round(max(price) + 1e-9, 6) as max_price, round(avg(price) + 1e-9, 6) as avg_price,
            count(distinct substr(isin, 1, 2)) as countries from instruments""",
        "row_sample": f"select row_number() over (order by doc_id) as number, doc_id, {shortened('text')} as text from (select * from docs order by doc_id limit 5)",
        "search_result_summary": f"""select count(*) as total_hits, least(count(*), 10000) as total_hits_capped,
            count(*) > 10000 as total_is_lower_bound, least(count(*), 100) as returned_hits,
            string_agg(case when rn <= 3 then doc_id || '|' || n_chars || '|' || {shortened('text')} end, ' ; ' order by rn) as sample_data
            from (select *, row_number() over (order by n_chars, doc_id) as rn from docs
                where {all_words(['the', 'and'])} and n_chars between 100 and 900)""",
        "search_catalogue": catalogue(),
        "search_log_rows": """select search_id, search_type || ': ' || case search_id % 3
                when 0 then printf('$%.2f - $%.2f', low, low + total_hits % 100)
                when 1 then '''' || query_type || ''''
                else '''' || query_type || ''' + ' || printf('$%.2f - $%.2f', low, low + total_hits % 100) end as label,
            round(case when low is null then 0.0 else low + total_hits % 100 - low end + 1e-9, 6) as price_range_width,
            round(duration_ms + 1e-9, 6) as duration_ms,
            round(case when duration_ms = 0 then 0.0 else total_hits / (duration_ms / 1000 * 1000) end + 1e-9, 6) as hits_per_ms
            from (select *, case when search_id % 3 <> 1 then search_id / 4 end as low from searches)""",
        "dup_count": "select count(*) - count(distinct isin) as duplicates from dirty",
        "dedup_keep_first": """select isin, coalesce(name, 'NA') as name, long_name,
            coalesce(cast(cast(price as decimal(10,2)) as varchar), '') as price, row_order from first_copies""",
        "dedup_documents": "select doc_id, n_chars from (select *, row_number() over (partition by text order by doc_id) as rn from documents) where rn = 1",
        "missing_counts": """select * from (select 'name' as column_name, count_if(name is null) as missing from dirty
            union all select 'price', count_if(price is null) from dirty
            union all select 'isin', count_if(isin is null) from dirty
            union all select 'long_name', count_if(long_name is null) from dirty) where missing > 0""",
        "clean_load": "select isin, name, long_name, round(price + 1e-9, 6) as price, timestamp '2024-01-01 00:00:00' as updated_at from cleaned",
        "csv_import": "select isin, name, long_name, round(price + 1e-9, 6) as price, timestamp '2024-01-01 00:00:00' as updated_at from cleaned",
        "price_losses": """select 'missing' as reason, count_if(price is null and turn not in (5, 6, 7)) as rows from turns
            union all select 'no_number', count_if(turn = 7) from turns
            union all select 'too_large', count_if(turn in (5, 6)) from turns""",
        "load_report": """select 'read' as step, count(*) as rows from dirty
            union all select 'after_dedup', count(*) from first_copies
            union all select 'after_dropping_incomplete', count(*) from cleaned""",
        "upsert_replace": f"select isin, name, long_name, round(price + 1e-9, 6) as price, updated_at, update_iteration from ({REPLACED})",
        "patch_prices": PATCHED,
        "patch_prices_twice": PATCHED,
        "stream_patch_prices": PATCHED,
        "stream_replay": PATCHED,
        "stream_stop_and_go": PATCHED,
        "unmatched_changes": """select isin, round(price + 1e-9, 6) as price, updated_at, update_iteration, changes
            from latest where isin not in (select isin from target)""",
        "merge_tally": """select count(*) as total, count(t.isin) as success_count,
            count(*) - count(t.isin) as error_count, round(count(t.isin) / 2.5 + 1e-9, 6) as updates_per_second
            from changes c left join target t on c.isin = t.isin""",
        "stream_update_log": """select count(*) as total, count(t.isin) as success_count,
            count(*) - count(t.isin) as error_count, cast(0 as bigint) as odd_rates
            from changes c left join target t on c.isin = t.isin""",
        "stream_replay_log": """select count(*) as total, count(t.isin) as success_count, count(*) - count(t.isin) as error_count
            from changes c left join target t on c.isin = t.isin""",
        "batch_numbers": """select isin, rn as row_number, (rn - 1) // 1000 + 1 as batch,
            (rn - 1) // 1000 * 1000 + 1 as batch_start
            from (select isin, row_number() over (order by isin) as rn from instruments)""",
        "first_errors": """select batch, rank, isin from (select batch, isin,
                row_number() over (partition by batch order by isin) as rank
                from (select isin, (row_number() over (order by isin) - 1) // 1000 + 1 as batch from latest)
                where isin not in (select isin from target)) where rank <= 3""",
        "price_pass": f"""select isin, name, long_name, {price_of('k', 70)} as price,
            timestamp '2024-02-01 00:00:00' as updated_at, cast(3 as bigint) as update_iteration
            from (select *, {KEY_NUMBER} + 3 * 7919 as k from instruments)""",
        "search_totals": """select count(*) as total, count_if(success) as successful,
            count_if(not success) as failed, round(100 * avg(cast(success as integer)) + 1e-9, 6) as success_rate from searches""",
        "failed_searches": 'select search_id, "timestamp" from searches where not success',
        "search_duration_stats": summary("duration_ms", "good", True),
        "by_search_type": grouped("search_type"),
        "by_query_type": grouped("query_type"),
        "stream_summary": grouped("query_type"),
        "stream_update_summary": """select round(avg(duration_seconds) + 1e-9, 6) as mean,
            round(max(duration_seconds) + 1e-9, 6) as max, count(*) as count,
            round(median(duration_seconds) + 1e-9, 6) as median from updates""",
        "query_types": "select distinct query_type from searches",
        "box_stats": """select query_type, round(max(q1) + 1e-9, 6) as q1, round(max(median) + 1e-9, 6) as median,
            round(max(q3) + 1e-9, 6) as q3, round(min(case when inside then duration_ms end) + 1e-9, 6) as low_whisker,
            round(max(case when inside then duration_ms end) + 1e-9, 6) as high_whisker,
            count_if(not inside) as outliers from fenced group by query_type""",
        "box_outliers": """select query_type, round(duration_ms + 1e-9, 6) as value, count(*) as n from fenced
            where not inside group by query_type, duration_ms""",
        "update_totals": "select count(*) as iterations, cast(sum(success_count) as bigint) as updated, cast(sum(error_count) as bigint) as errors from updates",
        "update_duration_stats": summary("duration_seconds", "updates"),
        "update_rate_stats": summary("updates_per_second", "updates"),
        "run_ids": """select "timestamp", error_count, iteration, cast(sum(restarted) over (partition by error_count
                order by "timestamp" rows unbounded preceding) as bigint) as run_id
            from (select "timestamp", error_count, iteration, case when lag(iteration) over (partition by error_count
                order by "timestamp") > iteration then 1 else 0 end as restarted
                from (select "timestamp", error_count, iteration % 50 as iteration from updates))""",
        "log_checks": """select count(*) as rows,
            count_if(success_count + error_count < total_instruments) as partial_passes,
            count_if(success_count + error_count > total_instruments) as overcounted,
            count_if(abs(updates_per_second - expected) > 0.01 + expected * 0.005 / nullif(duration_seconds, 0)) as odd_rates
            from (select *, coalesce(success_count / nullif(duration_seconds, 0), 0) as expected from updates)""",
        "window_join": "select iteration, search_id, round(duration_ms + 1e-9, 6) as duration_ms from pairs",
        "window_stats": window_summary("pairs"),
        "window_stats_end_stamp": window_summary("end_pairs"),
        "window_count": "select count(*) as windows from per_window",
        "outside_windows": 'select search_id, "timestamp", round(duration_ms + 1e-9, 6) as duration_ms from outside',
        "window_join_bucketed": """select w.iteration, s.search_id from ten_minutes w
            join searches s on s."timestamp" between w.window_start and w.window_end""",
        "outside_windows_bucketed": """select s.search_id from searches s where not exists (select 1 from ten_minutes w
            where s."timestamp" between w.window_start and w.window_end)""",
        "correlations": f"""select pair, round(correlation + 1e-9, 6) as correlation, {LABEL} as label from (
            select 'update_duration_vs_search_time' as pair, {correlation('update_duration')} as correlation from per_window
            union all select 'update_rate_vs_search_time', {correlation('updates_per_second')} from per_window)""",
        "update_impact": """select round(during + 1e-9, 6) as during, round(during_by_search + 1e-9, 6) as during_by_search,
            round(outside_mean + 1e-9, 6) as outside, round((during - outside_mean) / outside_mean * 100 + 1e-9, 6) as impact_percent
            from (select avg(avg_search_duration) as during,
                sum(avg_search_duration * search_count) / sum(search_count) as during_by_search,
                (select avg(duration_ms) from outside) as outside_mean from per_window)""",
        "update_impact_nan": """select round(during + 1e-9, 6) as during, round(during_by_search + 1e-9, 6) as during_by_search,
            round(outside_mean + 1e-9, 6) as outside, round((during - outside_mean) / outside_mean * 100 + 1e-9, 6) as impact_percent
            from (select avg(avg_search_duration) as during,
                sum(avg_search_duration * search_count) / sum(search_count) as during_by_search,
                (select avg(duration_ms) from outside where search_id % 7 <> 2) as outside_mean from measured_per_window)""",
        "empty_report": """select cast(0 as bigint) as total, cast(0 as bigint) as successful, cast(0 as bigint) as failed,
            cast(null as double) as success_rate from (select count(*) from searches where search_id < 0)""",
        "empty_summary": """select avg(duration_ms) as mean, min(duration_ms) as min, max(duration_ms) as max,
            stddev_samp(duration_ms) as stddev, median(duration_ms) as median from good where search_id < 0""",
        "required_columns": """select * from (values ('isin', true, 'instruments'), ('name', true, 'instruments'),
            ('long_name', true, 'instruments'), ('price', true, 'instruments'), ('isin', false, 'documents'),
            ('name', false, 'documents'), ('long_name', false, 'documents'), ('price', false, 'documents'))
            as v(column_name, present, "table")""",
        "table_description": """select *, false as existed, true as exists from (values ('isin', 'string'), ('name', 'string'),
            ('long_name', 'string'), ('price', 'decimal(18,2)'), ('updated_at', 'timestamp'), ('update_iteration', 'bigint'))
            as v(column_name, data_type)""",
        "table_versions": """select cast(0 as bigint) as step, count(*) as rows, round(max(price) + 1e-9, 6) as max_price from instruments
            union all select 1, count(*), round(max(price) + 1e-9, 6) from instruments where price < 1000
            union all select 2, count(*), round(max(price) * 2 + 1e-9, 6) from instruments""",
        "unknown_search_types": """select s_suppkey as query_id, false as success, cast(0 as bigint) as total_hits,
            cast(0 as bigint) as returned_hits,
            'Unknown query type: ' || case when s_suppkey % 7 = 3 then 'fuzzy' else 'NULL' end as error
            from supplier where s_suppkey % 7 in (3, 5)""",
        "upsert_last_wins": """select isin, name, long_name, round(price + 1e-9, 6) as price, cast(null as timestamp) as updated_at,
                cast(null as bigint) as update_iteration from target where isin not in (select isin from latest)
            union all select isin, null, null, round(price + 1e-9, 6), updated_at, update_iteration from latest""",
        "stream_sketch_summary": """select query_type, count(*) as count, round(avg(duration_ms) + 1e-9, 6) as mean,
            round(max(duration_ms) + 1e-9, 6) as max, """ + ", ".join(
            f"round(quantile_cont(duration_ms, {p + side * RANK_ERROR}) + 1e-9, 6) as {name}_{end}"
            for name, p in (("low", 0.25), ("median", 0.5), ("high", 0.9))
            for side, end in ((-1, "from"), (1, "to"))
        ) + ", true as within from measured group by query_type",
        "impact_lines": """select unnest(['Search time during updates', 'Search time without updates', 'Performance impact']) as measure,
            unnest([printf('%.2f', during) || 'ms', printf('%.2f', outside_mean) || 'ms',
                printf('%+.1f', (during - outside_mean) / outside_mean * 100) || '%']) as text
            from (select avg(avg_search_duration) as during,
                (select avg(duration_ms) from outside) as outside_mean from per_window)""",
        "impact_by_type": """select query_type, during_count, round(during + 1e-9, 6) as during, outside_count,
            round(outside_mean + 1e-9, 6) as outside, round((during - outside_mean) / outside_mean * 100 + 1e-9, 6) as impact_percent
            from (select query_type, count_if(inside) as during_count, count_if(not inside) as outside_count,
                avg(case when inside then duration_ms end) as during, avg(case when not inside then duration_ms end) as outside_mean
                from (select g.*, exists (select 1 from windows w
                    where g."timestamp" between w.window_start and w.window_end) as inside from good g) group by query_type)""",
        "search_over_time": """select date_trunc('hour', "timestamp") as window_start, query_type, count(*) as count,
            round(avg(duration_ms) + 1e-9, 6) as mean, round(max(duration_ms) + 1e-9, 6) as max from good group by all""",
        "series_search": 'select "timestamp", round(duration_ms + 1e-9, 6) as duration_ms from good',
        "series_update": 'select "timestamp", round(updates_per_second + 1e-9, 6) as updates_per_second from updates',
        "overlay": """select "timestamp", 'search' as kind, round(duration_ms + 1e-9, 6) as duration_ms from good
            union all select "timestamp", 'update_start', null from updates""",
        "window_seconds": """select iteration, cast(floor(duration_seconds) as bigint) + 1 as steps,
            window_start + to_seconds(cast(floor(duration_seconds) as bigint)) as last_step from windows""",
        "update_log_csv": """select "timestamp", iteration, total_instruments, success_count, error_count,
            round(duration_seconds, 2) as duration_seconds, round(updates_per_second, 2) as updates_per_second from updates""",
        "search_log_lines": """select search_id, query_type,
            case when search_id % 11 <> 3 then round(duration_ms + 1e-9, 6) end as duration_ms,
            case when search_id % 5 = 0 then length('timed out,' || chr(10) || ' after "' || search_id || '" ms' || chr(10) || chr(10))
                else 0 end as error_length
            from searches where search_id % 13 <> 4""",
        "unreadable_log_rows": """select 'rows' as what, count(*) as count from searches
            union all select 'misfits', count_if(search_id % 13 = 4) from searches
            union all select 'search_id', 0
            union all select 'duration_ms', count_if(search_id % 13 <> 4 and search_id % 11 = 3) from searches""",
        "search_log_csv": """select "timestamp", search_id, search_type, success,
            nullif(cast(search_id as double), 0) as min_price,
            nullif(cast(total_hits % 10 as double), 0) as price_range_width,
            round(duration_ms, 2) as duration_ms, total_hits, least(total_hits, 100) as returned_hits,
            cast(case when success then 1 else 0 end as bigint) as samples,
            case when success then 'O''Neil "A", ' || query_type end as first_name,
            case when success then duration_ms end as first_price from searches""",
    }
    sql = {name: with_views(text) for name, text in twins.items()}
    sql["word_table_all_terms"] = sql["text_all_terms"]
    sql["word_table_bm25_top3"] = sql["text_bm25_top3"]
    sql["stream_search_over_time"] = sql["search_over_time"]
    sql["stream_search_totals"] = sql["search_totals"]
    sql["stream_update_totals"] = sql["update_totals"]
    sql["batch_combined_search"] = with_views(RANKED.format(key="doc_id"), **doc_match)
    sql["batch_search_totals"] = with_views(COUNTED, **doc_match)
    sql["batch_text_search"] = with_views(RANKED.format(key="doc_id"), **text_match)
    sql["batch_range_search"] = with_views(RANKED.format(key="isin"), **range_match)
    sql["catalogue_totals"] = with_views(
        """select q.query_id, count(m.query_id) as total_hits
            from requests q left join matched m on q.query_id = m.query_id group by q.query_id""",
        requests=f"select query_id, min_price, max_price, case when terms is null then [] else {words_of('terms')} end as asked from named",
        named=catalogue(),
        items=f"select *, {words_of('long_name')} as words from instruments",
        matched=MATCHED.format(key="isin", price="price", items="items"),
    )
    sql["stream_search_log"] = with_views(
        f"""select q.query_id as search_id, q.search_type, q.query_type, q.min_price, q.max_price,
            round(coalesce(q.max_price - q.min_price, 0.0), 2) as price_range_width, q.terms as text_query,
            true as success, c.total_hits, c.returned_hits, coalesce(s.sample_data, '') as sample_data
        from requests q join counted c on q.query_id = c.query_id
        left join samples s on s.query_id = q.query_id""",
        counted=COUNTED,
        ranked=RANKED.format(key="doc_id"),
        samples=f"""select r.query_id, string_agg(r.doc_id || '|' || d.n_chars || '|' || {shortened('d.text')},
                ' ; ' order by r.rank) as sample_data
            from ranked r join docs d on d.doc_id = r.doc_id where r.rank <= 3 group by r.query_id""",
        **doc_match,
    )
    sql["synth_instruments"] = synthetic_sql("part", "p_partkey")
    sql["synth_profile"] = synthetic_profile("orders", "o_orderkey")
    return sql
