"""The registered queries in plain SQL over the source tables, for checking results.

Written independently of the operators: windows instead of joins, reachability instead of
contraction, window functions instead of counted positions.
"""

# Common table expressions, each with the names of those it needs.
PARTS: dict[str, tuple[str, str]] = {
    "ord": (
        "",
        """
        SELECT o_orderkey AS ok, o_custkey AS ck,
               CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS ts,
               lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_ok
        FROM orders""",
    ),
    "line": (
        "",
        """
        SELECT l_orderkey AS ok, l_linenumber, l_partkey, l_extendedprice,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                   l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) - 1 AS idx
        FROM lineitem""",
    ),
    "placed": (
        "ord line",
        """
        SELECT o.ok, o.ts, o.next_ok, l.idx,
               CAST(round(l.l_extendedprice * 10) AS BIGINT) * CAST(power(10, o.ck % 5) AS BIGINT) AS value,
               CASE WHEN l.idx IS NULL THEN NULL
                    WHEN l.l_partkey % 97 = 0 THEN CAST([] AS VARCHAR[])
                    WHEN l.l_linenumber = 7
                    THEN ['c' || o.ck || '-' || (l.l_partkey % 16), 'm' || (o.ck // 2)]
                    ELSE ['c' || o.ck || '-' || (l.l_partkey % 16)] END AS addresses,
               CASE WHEN l.idx IS NULL THEN NULL
                    WHEN l.l_partkey % 97 = 0 THEN 'nulldata'
                    WHEN l.l_linenumber = 7 THEN 'multisig' ELSE 'pubkeyhash' END AS output_type
        FROM ord o LEFT JOIN line l USING (ok)""",
    ),
    "outs": (
        "placed",
        """
        SELECT 'tx' || ok AS tx_hash, ts // 86400 AS block_number, ts AS block_timestamp,
               CAST(idx AS INTEGER) AS output_index, value, addresses, output_type
        FROM placed""",
    ),
    "spends": (
        "placed ord",
        """
        SELECT 'tx' || p.next_ok AS tx_hash, s.ts // 86400 AS block_number,
               s.ts AS block_timestamp,
               CAST(row_number() OVER (PARTITION BY p.next_ok ORDER BY p.idx) - 1 AS INTEGER) AS input_index,
               'tx' || p.ok AS spent_tx_hash, CAST(p.idx AS INTEGER) AS spent_output_index,
               CASE WHEN (p.ok + p.idx) % 3 = 0 THEN p.addresses END AS addresses, p.value
        FROM placed p JOIN ord s ON s.ok = p.next_ok
        WHERE p.idx IS NOT NULL AND (p.ok + p.idx) % 4 <> 0""",
    ),
    "tx": (
        "outs spends",
        """
        SELECT o.tx_hash AS hash, o.block_number, o.block_timestamp,
               CAST(coalesce(s.n, 0) AS INTEGER) AS input_count,
               CAST(o.n AS INTEGER) AS output_count, coalesce(s.n, 0) = 0 AS is_coinbase,
               CAST(o.value AS BIGINT) AS output_value
        FROM (SELECT tx_hash, block_number, block_timestamp, count(output_index) AS n,
                     coalesce(sum(value), 0) AS value
              FROM outs GROUP BY ALL) o
        LEFT JOIN (SELECT tx_hash, count(*) AS n FROM spends GROUP BY ALL) s USING (tx_hash)""",
    ),
    "ins": (
        "spends tx",
        """
        SELECT tx_hash, block_number, block_timestamp, FALSE AS is_coinbase, input_index,
               spent_tx_hash, spent_output_index, addresses, value FROM spends
        UNION ALL
        SELECT hash, block_number, block_timestamp, TRUE, NULL, NULL, NULL, NULL, NULL
        FROM tx WHERE is_coinbase""",
    ),
    "blk": (
        "tx",
        """
        SELECT block_number AS number, block_number * 86400 AS timestamp,
               CAST(count(*) AS INTEGER) AS transaction_count
        FROM tx GROUP BY ALL""",
    ),
    "utxo": (
        "outs spends",
        """
        SELECT * FROM outs o WHERE NOT EXISTS (
            SELECT 1 FROM spends s
            WHERE s.spent_tx_hash = o.tx_hash AND s.spent_output_index = o.output_index)""",
    ),
    "ci": (
        "spends tx outs",
        """
        SELECT * FROM (
            SELECT s.tx_hash,
                   CASE WHEN len(o.addresses) > 0 THEN o.addresses[1]
                        WHEN len(s.addresses) > 0 THEN s.addresses[1] END AS address
            FROM spends s JOIN tx t ON t.hash = s.tx_hash
            LEFT JOIN outs o ON o.tx_hash = s.spent_tx_hash
                            AND o.output_index = s.spent_output_index
            WHERE t.input_count >= 2 AND NOT t.is_coinbase)
        WHERE address IS NOT NULL""",
    ),
    "edge": (
        "ci",
        """
        SELECT DISTINCT src, address AS dst
        FROM (SELECT address, min(address) OVER (PARTITION BY tx_hash) AS src FROM ci)
        WHERE src < address""",
    ),
    "reach": (
        "edge",
        """
        SELECT src AS address, dst AS other FROM edge
        UNION SELECT dst, src FROM edge
        UNION
        SELECT r.address, e.other
        FROM reach r
        JOIN (SELECT src AS address, dst AS other FROM edge
              UNION ALL SELECT dst, src FROM edge) e ON e.address = r.other""",
    ),
    "ent": (
        "reach",
        """
        SELECT address, least(address, min(other)) AS entity_id FROM reach GROUP BY address""",
    ),
    "size": (
        "ent",
        "SELECT entity_id, count(*) AS address_count FROM ent GROUP BY entity_id",
    ),
    "utxo_address": (
        "utxo",
        """
        SELECT tx_hash, output_index, value, unnest(addresses) AS address FROM utxo""",
    ),
    "bal": (
        "utxo_address ent",
        """
        SELECT entity_id, CAST(sum(value) AS BIGINT) AS balance_satoshi, count(*) AS utxo_count,
               CAST(sum(value) AS DOUBLE) / 1e8 AS balance_btc
        FROM utxo_address JOIN ent USING (address) GROUP BY entity_id""",
    ),
    "total": (
        "bal",
        "SELECT CAST(sum(balance_satoshi) AS DOUBLE) / 1e8 AS btc, count(*) AS n FROM bal",
    ),
    "ranked": (
        "bal",
        """
        SELECT *, row_number() OVER (ORDER BY balance_satoshi DESC, entity_id) AS rank FROM bal""",
    ),
    "cat": (
        "bal",
        """
        SELECT *, CASE WHEN balance_btc >= 1000 THEN 'Mega Whale (1000+ BTC)'
                       WHEN balance_btc >= 100 THEN 'Whale (100-1000 BTC)'
                       WHEN balance_btc >= 10 THEN 'Large (10-100 BTC)'
                       WHEN balance_btc >= 1 THEN 'Medium (1-10 BTC)'
                       ELSE 'Small (<1 BTC)' END AS category
        FROM bal""",
    ),
    "coarse": (
        "bal",
        """
        SELECT entity_id, CASE WHEN balance_btc >= 1000 THEN 'Mega Whale (1000+ BTC)'
                               WHEN balance_btc >= 100 THEN 'Whale (100-1000 BTC)'
                               WHEN balance_btc >= 10 THEN 'Large (10-100 BTC)'
                               ELSE 'Small/Medium (<10 BTC)' END AS category
        FROM bal""",
    ),
    "hist": (
        "outs spends ent",
        """
        SELECT o.tx_hash, o.output_index, o.value, e.address, e.entity_id,
               o.block_timestamp AS created_timestamp, s.block_timestamp AS spent_timestamp
        FROM outs o JOIN ent e ON e.address = o.addresses[1]
        LEFT JOIN spends s ON s.spent_tx_hash = o.tx_hash
                          AND s.spent_output_index = o.output_index""",
    ),
    "event": (
        "hist",
        """
        SELECT entity_id, DATE '1970-01-01' + CAST(created_timestamp // 86400 AS INTEGER) AS event_date,
               value AS delta, 'CREATED' AS event_type FROM hist
        UNION ALL
        SELECT entity_id, DATE '1970-01-01' + CAST(spent_timestamp // 86400 AS INTEGER),
               -value, 'SPENT' FROM hist WHERE spent_timestamp IS NOT NULL""",
    ),
    "day": (
        "event",
        """
        SELECT entity_id, event_date, CAST(sum(delta) AS BIGINT) AS daily_delta,
               CAST(sum(CASE WHEN delta > 0 THEN delta ELSE 0 END) AS BIGINT) AS daily_inflow,
               CAST(sum(CASE WHEN delta < 0 THEN delta ELSE 0 END) AS BIGINT) AS daily_outflow
        FROM event GROUP BY entity_id, event_date""",
    ),
    # BTC to 4 places as a whole number of ten-thousandths, halves away from zero.
    "timeline": (
        "day",
        """
        SELECT *, sign(cumulative_satoshi) * ((abs(cumulative_satoshi) + 5000) // 10000) AS units
        FROM (SELECT entity_id, event_date, daily_delta,
                     CAST(sum(daily_delta) OVER (PARTITION BY entity_id ORDER BY event_date) AS BIGINT)
                         AS cumulative_satoshi
              FROM day)""",
    ),
    "flow": (
        "day bal",
        """
        SELECT strftime(event_date, '%Y-%m') AS year_month,
               CAST(sum(daily_delta) AS BIGINT) AS net_change_satoshi,
               CAST(sum(daily_inflow) AS BIGINT) AS inflows,
               CAST(sum(daily_outflow) AS BIGINT) AS outflows
        FROM day WHERE entity_id IN (SELECT entity_id FROM bal WHERE balance_btc >= 100)
        GROUP BY 1""",
    ),
    "flow_btc": (
        "flow",
        """
        SELECT *,
               sign(net_change_satoshi) * ((abs(net_change_satoshi) + 500000) // 1000000) AS net_units,
               sign(inflows) * ((abs(inflows) + 500000) // 1000000) AS in_units,
               sign(outflows) * ((abs(outflows) + 500000) // 1000000) AS out_units
        FROM flow""",
    ),
    "mega": (
        "bal",
        """
        SELECT count(*) FILTER (balance_btc >= 1000) AS mega_count,
               coalesce(CAST(sum(balance_satoshi) FILTER (balance_btc >= 1000) AS DOUBLE) / 1e8, 0) AS mega_btc,
               coalesce(CAST(sum(balance_satoshi) AS DOUBLE) / 1e8, 0) AS total_btc
        FROM bal""",
    ),
    "summary": (
        "ent",
        """
        SELECT count(*) AS address_count, count(DISTINCT entity_id) AS entity_count FROM ent""",
    ),
    "top20": (
        "ranked",
        "SELECT CAST(sum(balance_satoshi) AS DOUBLE) / 1e8 AS btc FROM ranked WHERE rank <= 20",
    ),
}


# The first two of three periods of the growing ledger: their last days.
PERIODS = (9951, 10742)

PARTS["cid"] = (
    "spends tx outs",
    """
    SELECT * FROM (
        SELECT s.tx_hash, s.block_number AS day,
               CASE WHEN len(o.addresses) > 0 THEN o.addresses[1]
                    WHEN len(s.addresses) > 0 THEN s.addresses[1] END AS address
        FROM spends s JOIN tx t ON t.hash = s.tx_hash
        LEFT JOIN outs o ON o.tx_hash = s.spent_tx_hash
                        AND o.output_index = s.spent_output_index
        WHERE t.input_count >= 2 AND NOT t.is_coinbase)
    WHERE address IS NOT NULL""",
)
for _number, _last in enumerate(PERIODS, 1):
    PARTS[f"edge{_number}"] = (
        "cid",
        f"""
        SELECT DISTINCT src, address AS dst
        FROM (SELECT address, min(address) OVER (PARTITION BY tx_hash) AS src
              FROM cid WHERE day <= {_last})
        WHERE src < address""",
    )
    PARTS[f"reach{_number}"] = (
        f"edge{_number}",
        f"""
        SELECT src AS address, dst AS other FROM edge{_number}
        UNION SELECT dst, src FROM edge{_number}
        UNION
        SELECT r.address, e.other
        FROM reach{_number} r
        JOIN (SELECT src AS address, dst AS other FROM edge{_number}
              UNION ALL SELECT dst, src FROM edge{_number}) e ON e.address = r.other""",
    )
    PARTS[f"ent{_number}"] = (
        f"reach{_number}",
        f"""
        SELECT address, least(address, min(other)) AS entity_id FROM reach{_number} GROUP BY address""",
    )
PARTS["damage"] = (
    "tx",
    """
    SELECT *, CASE WHEN input_count + output_count <= 40
                   THEN CAST(substr(hash, 3) AS BIGINT) % 20 END AS harm,
           strftime(make_timestamp(block_timestamp * 1000000), '%Y-%m') AS year_month
    FROM tx""",
)

PARTS["month_end"] = (
    "timeline",
    """
    SELECT entity_id, CAST(date_trunc('month', event_date) AS DATE) AS month,
           arg_max(cumulative_satoshi, event_date) AS sat,
           CASE WHEN sat >= 100000000000 THEN 'Mega Whale (1000+ BTC)'
                WHEN sat >= 10000000000 THEN 'Whale (100-1000 BTC)'
                WHEN sat >= 1000000000 THEN 'Large (10-100 BTC)'
                ELSE 'Small/Medium (<10 BTC)' END AS category
    FROM timeline GROUP BY entity_id, 2""",
)
PARTS["member"] = ("ci", "SELECT DISTINCT tx_hash, address FROM ci")
PARTS["near"] = (
    "member",
    """
    SELECT x.tx_hash, x.address, y.address AS other
    FROM member x JOIN member y USING (tx_hash) WHERE x.address <> y.address""",
)
# Where one gets from an address without its place among the inputs of one transaction.
PARTS["side"] = (
    "near",
    """
    SELECT DISTINCT tx_hash, address, address AS node FROM near
    UNION
    SELECT s.tx_hash, s.address, n.other
    FROM side s JOIN near n ON n.address = s.node
    WHERE NOT (n.tx_hash = s.tx_hash AND (n.address = s.address OR n.other = s.address))""",
)


def _with(names: str, select: str) -> str:
    """``select`` preceded by the named expressions and all they need, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in PARTS[name][0].split():
                add(needed)
            ordered.append(name)

    for name in names.split():
        add(name)
    body = ",\n".join(
        f"{name} AS {'' if name == 'reach' else 'MATERIALIZED '}({PARTS[name][1]})"
        for name in ordered
    )
    return f"WITH RECURSIVE {body}\n{select}"


_OUTPUT_COLUMNS = """tx_hash, block_number, block_timestamp, output_index, value,
    array_to_string(addresses, ',') AS addresses, output_type"""

# Equal-width bins of a whole-number column x of table t.
_HISTOGRAM = """
    SELECT bin, low - spread + bin * step AS bin_start, low - spread + (bin + 1) * step AS bin_end,
           coalesce(n, 0) AS entity_count
    FROM (SELECT *, (high + spread - (low - spread)) / 50.0 AS step
          FROM (SELECT CAST(min(x) AS DOUBLE) AS low, CAST(max(x) AS DOUBLE) AS high,
                       CASE WHEN max(x) > min(x) THEN CAST(0 AS DOUBLE) ELSE 0.5 END AS spread FROM t))
    CROSS JOIN (SELECT CAST(unnest(range(50)) AS INTEGER) AS bin)
    LEFT JOIN (
        SELECT CASE WHEN high > low THEN least((x - low) * 50 // (high - low), 49) ELSE 25 END AS bin,
               count(*) AS n
        FROM t, (SELECT min(x) AS low, max(x) AS high FROM t) GROUP BY 1) USING (bin)"""

ORACLE: dict[str, str] = {
    "outputs_flat": _with("outs", f"SELECT {_OUTPUT_COLUMNS} FROM outs"),
    "inputs_flat": _with(
        "ins",
        """SELECT tx_hash, block_number, block_timestamp, is_coinbase, input_index, spent_tx_hash,
                  spent_output_index, array_to_string(addresses, ',') AS addresses, value
           FROM ins""",
    ),
    "spent_references": _with(
        "spends",
        "SELECT DISTINCT spent_tx_hash AS tx_hash, spent_output_index AS output_index FROM spends",
    ),
    "utxo_set": _with("utxo", f"SELECT {_OUTPUT_COLUMNS} FROM utxo"),
    "spent_summary": _with(
        "outs utxo",
        """SELECT o AS output_count, o - u AS spent_count, u AS utxo_count,
                  CAST(o - u AS DOUBLE) / o * 100.0 AS spent_pct,
                  CAST(u AS DOUBLE) / o * 100.0 AS utxo_pct
           FROM (SELECT count(*) AS o FROM outs), (SELECT count(*) AS u FROM utxo)""",
    ),
    "utxo_addresses": _with(
        "utxo_address", "SELECT tx_hash, output_index, value, address FROM utxo_address"
    ),
    "input_count_distribution": _with(
        "tx",
        """SELECT input_count, count(*) AS tx_count FROM tx WHERE NOT is_coinbase
           GROUP BY input_count ORDER BY input_count""",
    ),
    "input_count_head": _with(
        "tx",
        """SELECT input_count, count(*) AS tx_count FROM tx
           WHERE NOT is_coinbase AND input_count <= 20
           GROUP BY input_count ORDER BY input_count LIMIT 15""",
    ),
    "input_split": _with(
        "tx",
        """SELECT t AS total_count, s AS single_count, m AS multi_count,
                  CAST(s AS DOUBLE) / t * 100.0 AS single_pct,
                  CAST(m AS DOUBLE) / t * 100.0 AS multi_pct
           FROM (SELECT count(*) AS t, count(*) FILTER (input_count = 1) AS s,
                        count(*) FILTER (input_count > 1) AS m
                 FROM tx WHERE NOT is_coinbase)""",
    ),
    "data_summary": _with(
        "tx blk",
        """SELECT t AS total_transactions, total_blocks, min_block, max_block,
                  m AS multi_input_transactions, CAST(m AS DOUBLE) / t AS multi_input_ratio
           FROM (SELECT count(*) AS t,
                        count(*) FILTER (input_count >= 2 AND NOT is_coinbase) AS m FROM tx),
                (SELECT count(*) AS total_blocks, min(number) AS min_block,
                        max(number) AS max_block FROM blk)""",
    ),
    "block_table": _with("blk", "SELECT * FROM blk"),
    "example_multi_input_tx": _with(
        "tx spends",
        """SELECT t.hash, t.block_number, t.input_count,
                  t.output_count, CAST(t.output_value AS DOUBLE) / 1e8 AS value_btc,
                  (SELECT to_json(list(s.addresses[1] ORDER BY s.input_index))
                   FROM spends s WHERE s.tx_hash = t.hash) AS input_addresses
           FROM (SELECT * FROM tx WHERE input_count BETWEEN 3 AND 10 AND NOT is_coinbase
                 ORDER BY block_number, hash LIMIT 1) t""",
    ),
    "tx_preview": _with(
        "tx",
        """SELECT hash, block_number, input_count, output_count, is_coinbase, output_value,
                  CAST(NULL AS BIGINT) AS fee
           FROM tx ORDER BY block_number, hash LIMIT 5""",
    ),
    "clustering_inputs": _with("ci", "SELECT tx_hash, address FROM ci"),
    "tx_address_sets": _with(
        "ci",
        """SELECT DISTINCT tx_hash, address FROM ci
           WHERE tx_hash IN (SELECT tx_hash FROM ci GROUP BY tx_hash
                             HAVING count(DISTINCT address) >= 2)""",
    ),
    "co_input_edges": _with("edge", "SELECT src, dst FROM edge"),
    "graph_vertices": _with("edge", "SELECT src AS id FROM edge UNION SELECT dst FROM edge"),
    "entities": _with("ent", "SELECT address, entity_id FROM ent"),
    "entities_with_singletons": _with(
        "ent outs",
        """SELECT address, entity_id FROM ent
           UNION
           SELECT addresses[1], addresses[1] FROM outs
           WHERE addresses[1] IS NOT NULL AND addresses[1] NOT IN (SELECT address FROM ent)""",
    ),
    "clustering_summary": _with(
        "summary",
        """SELECT address_count, entity_count,
                  CAST(address_count - entity_count AS DOUBLE) / address_count * 100.0 AS reduction_pct
           FROM summary""",
    ),
    "entity_sizes": _with("size", "SELECT entity_id, address_count FROM size"),
    "top_entities_by_size": _with(
        "size",
        """SELECT CAST(row_number() OVER (ORDER BY address_count DESC, entity_id) AS INTEGER) AS rank,
                  entity_id, address_count,
                  CASE WHEN address_count > 10000 THEN 'Exchange'
                       WHEN address_count > 1000 THEN 'Mining pool'
                       WHEN address_count > 100 THEN 'Merchant or service'
                       WHEN address_count > 10 THEN 'Active user or trader'
                       ELSE 'Casual user' END AS likely_identity
           FROM size ORDER BY rank LIMIT 20""",
    ),
    "entity_size_histogram": _with(
        "size", f"SELECT * FROM (WITH t AS (SELECT address_count AS x FROM size) {_HISTOGRAM})"
    ),
    "entity_balances": _with(
        "bal", "SELECT entity_id, balance_satoshi, utxo_count, balance_btc FROM bal"
    ),
    "balance_totals": _with(
        "total",
        "SELECT n AS entities_with_balance, btc AS total_btc, btc / n AS average_btc FROM total",
    ),
    "top_whales": _with(
        "ranked total",
        """SELECT CAST(rank AS INTEGER) AS rank, entity_id, balance_satoshi, balance_btc, utxo_count,
                  balance_btc / btc * 100.0 AS share_pct
           FROM ranked, total WHERE rank <= 20""",
    ),
    "top_whale_share": _with(
        "ranked total",
        """SELECT CAST(k AS INTEGER) AS k, top_btc, top_btc / btc * 100.0 AS top_share_pct
           FROM (SELECT k, CAST(sum(balance_satoshi) AS DOUBLE) / 1e8 AS top_btc
                 FROM ranked JOIN (SELECT unnest([10, 20]) AS k) ON rank <= k GROUP BY k), total""",
    ),
    "largest_entity": _with(
        "ranked",
        "SELECT entity_id, balance_satoshi, balance_btc, utxo_count FROM ranked WHERE rank = 1",
    ),
    "whale_categories": _with(
        "cat total",
        """SELECT category, count(*) AS entity_count,
                  CAST(sum(balance_satoshi) AS DOUBLE) / 1e8 AS total_btc,
                  CAST(sum(utxo_count) AS BIGINT) AS total_utxos,
                  CAST(count(*) AS DOUBLE) / any_value(n) * 100.0 AS entity_pct,
                  CAST(sum(balance_satoshi) AS DOUBLE) / 1e8 / any_value(btc) * 100.0 AS btc_pct
           FROM cat, total GROUP BY category""",
    ),
    "whale_concentration": _with(
        "mega",
        """SELECT mega_count, mega_btc, total_btc,
                  coalesce(mega_btc / nullif(total_btc, 0) * 100.0, 0) AS mega_share_pct
           FROM mega""",
    ),
    "largest_entity_members": _with(
        "ent ranked",
        """SELECT address, entity_id FROM ent
           WHERE entity_id = (SELECT entity_id FROM ranked WHERE rank = 1)""",
    ),
    "whale_addresses": _with(
        "utxo_address ent ranked",
        """SELECT address, CAST(sum(value) AS BIGINT) AS balance_satoshi, count(*) AS utxo_count,
                  CAST(sum(value) AS DOUBLE) / 1e8 AS balance_btc
           FROM utxo_address
           WHERE address IN (SELECT address FROM ent
                             WHERE entity_id = (SELECT entity_id FROM ranked WHERE rank = 1))
           GROUP BY address""",
    ),
    "top_whale_addresses": _with(
        "utxo_address ent ranked",
        """SELECT address, CAST(sum(value) AS BIGINT) AS balance_satoshi, count(*) AS utxo_count,
                  CAST(sum(value) AS DOUBLE) / 1e8 AS balance_btc
           FROM utxo_address
           WHERE address IN (SELECT address FROM ent
                             WHERE entity_id = (SELECT entity_id FROM ranked WHERE rank = 1))
           GROUP BY address ORDER BY balance_satoshi DESC, address LIMIT 10""",
    ),
    "balance_statistics": _with(
        "ranked",
        """SELECT count(*) AS entity_count, min(balance_btc) AS min_btc,
                  median(balance_btc) AS median_btc,
                  CAST(sum(balance_satoshi) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * 1e8) AS mean_btc,
                  max(balance_btc) AS max_btc, round(stddev_samp(balance_btc), 4) AS stddev_btc
           FROM ranked""",
    ),
    "balance_histogram": _with(
        "ranked",
        f"""SELECT * FROM (WITH t AS (SELECT balance_satoshi AS x FROM ranked)
            {_HISTOGRAM})""",
    ),
    "utxo_history": _with("hist", "SELECT * FROM hist"),
    "utxo_history_direct": _with("hist", "SELECT * FROM hist"),
    "history_counts": _with(
        "hist",
        """SELECT count(*) AS total_outputs, count(spent_timestamp) AS spent_outputs,
                  count(*) - count(spent_timestamp) AS unspent_outputs FROM hist""",
    ),
    "balance_events": _with(
        "event",
        "SELECT entity_id, CAST(event_date AS VARCHAR) AS event_date, delta, event_type FROM event",
    ),
    "event_counts": _with(
        "event", "SELECT event_type, count(*) AS event_count FROM event GROUP BY event_type"
    ),
    "daily_changes": _with(
        "day",
        """SELECT entity_id, CAST(event_date AS VARCHAR) AS event_date, daily_delta, daily_inflow,
                  daily_outflow FROM day""",
    ),
    "entity_timeline": _with(
        "timeline",
        """SELECT entity_id, CAST(event_date AS VARCHAR) AS event_date, daily_delta,
                  cumulative_satoshi, CAST(units AS DOUBLE) / 1e4 AS cumulative_btc
           FROM timeline""",
    ),
    "timeline_counts": _with(
        "timeline",
        """SELECT count(*) AS timeline_rows, count(DISTINCT entity_id) AS entity_count
           FROM timeline""",
    ),
    "top_whale_trajectories": _with(
        "timeline ranked",
        """SELECT entity_id, CAST(event_date AS VARCHAR) AS event_date,
                  CAST(units AS DOUBLE) / 1e4 AS cumulative_btc
           FROM timeline
           WHERE entity_id IN (SELECT entity_id FROM ranked WHERE rank <= 5)""",
    ),
    "largest_entity_timeline": _with(
        "timeline ranked",
        """SELECT CAST(event_date AS VARCHAR) AS event_date, daily_delta,
                  CAST(units AS DOUBLE) / 1e4 AS cumulative_btc
           FROM timeline
           WHERE entity_id = (SELECT entity_id FROM ranked WHERE rank = 1)
           ORDER BY event_date LIMIT 10""",
    ),
    "category_by_month_head": _with(
        "timeline coarse",
        """SELECT strftime(event_date, '%Y-%m') AS year_month, category,
                  CAST(sum(units) AS DOUBLE) / 1e4 AS total_btc
           FROM timeline JOIN coarse USING (entity_id) GROUP BY ALL
           ORDER BY year_month, category LIMIT 10""",
    ),
    "category_by_month": _with(
        "timeline coarse",
        """SELECT strftime(event_date, '%Y-%m') AS year_month, category,
                  CAST(sum(units) AS DOUBLE) / 1e4 AS total_btc
           FROM timeline JOIN coarse USING (entity_id) GROUP BY ALL""",
    ),
    "category_month_end": _with(
        "timeline coarse",
        """SELECT strftime(month, '%Y-%m') AS year_month, category,
                  CAST(sum(cumulative_satoshi) AS DOUBLE) / 1e8 AS total_btc
           FROM (
               SELECT m.month, c.category, t.entity_id, t.cumulative_satoshi,
                      row_number() OVER (PARTITION BY m.month, t.entity_id
                                         ORDER BY t.event_date DESC) AS latest
               FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(event_date)),
                                 date_trunc('month', max(event_date)), INTERVAL 1 MONTH)) AS DATE) AS month
                     FROM timeline JOIN coarse USING (entity_id)) m
               JOIN timeline t ON t.event_date < m.month + INTERVAL 1 MONTH
               JOIN coarse c USING (entity_id))
           WHERE latest = 1 GROUP BY ALL""",
    ),
    "whale_monthly_flow": _with(
        "flow_btc",
        """SELECT year_month, net_change_satoshi, inflows, outflows,
                  CAST(net_units AS DOUBLE) / 1e2 AS net_change_btc,
                  CAST(in_units AS DOUBLE) / 1e2 AS inflows_btc,
                  CAST(out_units AS DOUBLE) / 1e2 AS outflows_btc
           FROM flow_btc""",
    ),
    "whale_recent_flow": _with(
        "flow_btc",
        """SELECT year_month, net_change_satoshi, inflows, outflows,
                  CAST(net_units AS DOUBLE) / 1e2 AS net_change_btc,
                  CAST(in_units AS DOUBLE) / 1e2 AS inflows_btc,
                  CAST(out_units AS DOUBLE) / 1e2 AS outflows_btc
           FROM flow_btc ORDER BY year_month DESC LIMIT 12""",
    ),
    "whale_trend": _with(
        "flow_btc",
        """SELECT year_month, CAST(net_units AS DOUBLE) / 1e2 AS net_change_btc,
                  CAST(in_units AS DOUBLE) / 1e2 AS inflows_btc,
                  CAST(out_units AS DOUBLE) / 1e2 AS outflows_btc,
                  CAST(sum(net_units) OVER (ORDER BY year_month) AS DOUBLE) / 1e2 AS cumulative_net_btc,
                  CASE WHEN sum(net_units) OVER () > 0 THEN 'accumulation' ELSE 'distribution' END AS trend
           FROM (SELECT * FROM flow_btc ORDER BY year_month DESC LIMIT 24)""",
    ),
    "global_counts": _with(
        "tx blk outs utxo ci edge ent hist",
        """SELECT (SELECT count(*) FROM tx) AS transactions, (SELECT count(*) FROM blk) AS blocks,
                  (SELECT count(*) FROM outs) AS outputs, (SELECT count(*) FROM utxo) AS utxos,
                  (SELECT count(*) FROM ci) AS clustering_inputs,
                  (SELECT count(*) FROM edge) AS edges, (SELECT count(*) FROM ent) AS vertices,
                  (SELECT count(DISTINCT entity_id) FROM ent) AS entities,
                  (SELECT count(*) FROM hist) AS history_rows""",
    ),
    "executive_report": _with(
        "tx blk outs utxo summary mega top20",
        """SELECT (SELECT count(*) FROM blk) AS blocks, (SELECT count(*) FROM tx) AS transactions,
                  (SELECT count(*) FROM outs) AS outputs, (SELECT count(*) FROM utxo) AS utxos,
                  address_count AS addresses, entity_count AS entities,
                  CAST(address_count - entity_count AS DOUBLE) / address_count * 100.0 AS reduction_pct,
                  total_btc, mega_count, mega_btc,
                  coalesce(mega_btc / nullif(total_btc, 0) * 100.0, 0) AS mega_share_pct,
                  btc AS top20_btc, btc / total_btc * 100.0 AS top20_share_pct
           FROM summary, mega, top20""",
    ),
    "key_metrics": _with(
        "tx summary mega",
        """SELECT metric, value, value / max(value) OVER () AS relative
           FROM (SELECT 'transactions' AS metric, CAST(count(*) AS DOUBLE) AS value FROM tx
                 UNION ALL SELECT 'addresses', address_count FROM summary
                 UNION ALL SELECT 'entities', entity_count FROM summary
                 UNION ALL SELECT 'total_btc', total_btc FROM mega
                 UNION ALL SELECT 'mega_count', mega_count FROM mega)""",
    ),
    "json_scan": _with(
        "outs",
        """SELECT strftime(DATE '1970-01-01' + CAST(block_number AS INTEGER), '%Y-%m') AS year_month,
                  count(*) AS output_rows, CAST(sum(value) AS BIGINT) AS value
           FROM outs GROUP BY 1""",
    ),
    "json_scan_pruned": _with(
        "outs", f"SELECT {_OUTPUT_COLUMNS} FROM outs"
    ),
    "loaded_transactions": _with(
        "tx",
        """SELECT hash, input_count, output_count,
                  block_timestamp AS block_seconds,
                  strftime(make_timestamp(block_timestamp * 1000000), '%Y-%m') AS year_month
           FROM tx""",
    ),
    "loaded_blocks": _with(
        "blk",
        "SELECT number, transaction_count, timestamp AS block_seconds FROM blk",
    ),
    "json_scan_inferred": _with(
        "tx",
        """SELECT block_number, count(*) AS transactions, CAST(sum(output_count) AS BIGINT) AS outputs
           FROM tx GROUP BY block_number""",
    ),
    "json_block_scan": _with(
        "blk",
        """SELECT number, timestamp, transaction_count,
                  strftime(DATE '1970-01-01' + CAST(number AS INTEGER), '%Y-%m-01') AS date
           FROM blk""",
    ),
    "entities_by_batches": _with("ent", "SELECT address, entity_id FROM ent"),
    "entity_merges": _with(
        "ent1 ent2 ent",
        """SELECT DISTINCT a.entity_id AS entity, b.entity_id AS merged_into, CAST(2 AS BIGINT) AS batch
           FROM ent1 a JOIN ent2 b USING (address) WHERE a.entity_id <> b.entity_id
           UNION ALL
           SELECT DISTINCT a.entity_id, b.entity_id, 3
           FROM ent2 a JOIN ent b USING (address) WHERE a.entity_id <> b.entity_id""",
    ),
    "utxo_after_undo": _with(
        "outs spends",
        f"""SELECT {_OUTPUT_COLUMNS} FROM outs o WHERE block_number <= {PERIODS[0]} AND NOT EXISTS (
               SELECT 1 FROM spends s WHERE s.block_number <= {PERIODS[0]}
               AND s.spent_tx_hash = o.tx_hash AND s.spent_output_index = o.output_index)""",
    ),
    "utxo_after_reorganisation": _with("utxo", f"SELECT {_OUTPUT_COLUMNS} FROM utxo"),
    "spent_by_last_period": _with(
        "outs spends",
        f"""SELECT o.tx_hash, o.output_index, o.value
            FROM outs o JOIN (SELECT spent_tx_hash, spent_output_index, min(block_number) AS first
                              FROM spends GROUP BY ALL) s
              ON s.spent_tx_hash = o.tx_hash AND s.spent_output_index = o.output_index
            WHERE o.block_number <= {PERIODS[1]} AND s.first > {PERIODS[1]}""",
    ),
    "utxo_set_keyed": _with("utxo", f"SELECT {_OUTPUT_COLUMNS} FROM utxo"),
    "clustering_inputs_keyed": _with("ci", "SELECT tx_hash, address FROM ci"),
    "utxo_history_keyed": _with("hist", "SELECT * FROM hist"),
    "loaded_good_lines": _with(
        "damage",
        """SELECT hash, block_number, input_count, output_count FROM damage
           WHERE harm IS NULL OR harm > 3""",
    ),
    "quarantined_lines": _with(
        "damage",
        """SELECT year_month, CASE WHEN harm < 2 THEN 'torn' WHEN harm = 2 THEN 'no key'
                                   ELSE 'mistyped' END AS reason, count(*) AS lines
           FROM damage WHERE harm <= 3 GROUP BY ALL""",
    ),
    "ingested_transactions": _with(
        "damage",
        """SELECT hash, block_number, input_count, output_count FROM damage
           WHERE harm IS NULL OR harm > 3""",
    ),
    "ingested_folders": _with(
        "damage",
        """SELECT CASE WHEN CAST(year_month[6:7] AS INTEGER) <= 6 THEN CAST(0 AS BIGINT) ELSE 1 END AS run,
                  count(DISTINCT year_month) AS months
           FROM damage GROUP BY ALL""",
    ),
    "category_intervals": _with(
        "month_end",
        """SELECT entity_id, category, strftime(month, '%Y-%m') AS first_month,
                  strftime(lead(month) OVER (PARTITION BY entity_id ORDER BY month), '%Y-%m') AS until
           FROM (SELECT *, lag(category) OVER (PARTITION BY entity_id ORDER BY month) AS before
                 FROM month_end)
           WHERE category IS DISTINCT FROM before""",
    ),
    "category_month_end_then": _with(
        "month_end",
        """SELECT strftime(m.month, '%Y-%m') AS year_month, e.category,
                  CAST(sum(e.sat) AS DOUBLE) / 1e8 AS total_btc, count(*) AS entity_count
           FROM (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE)
                        AS month FROM month_end) m
           JOIN (SELECT *, lead(month) OVER (PARTITION BY entity_id ORDER BY month) AS until
                 FROM month_end) e
             ON e.month <= m.month AND (e.until IS NULL OR m.month < e.until)
           GROUP BY ALL""",
    ),
    "timeline_by_periods": _with(
        "timeline",
        """SELECT entity_id, CAST(event_date AS VARCHAR) AS event_date, daily_delta,
                  cumulative_satoshi, CAST(units AS DOUBLE) / 1e4 AS cumulative_btc
           FROM timeline""",
    ),
    "entity_bridges": _with(
        "side ent size",
        """SELECT tx_hash, address, entity_id,
                  CAST(CASE WHEN with_first THEN whole - n ELSE n END AS BIGINT) AS cut_off,
                  CAST(CASE WHEN with_first THEN n ELSE whole - n END AS BIGINT) AS rest
           FROM (SELECT s.tx_hash, s.address, e.entity_id, any_value(z.address_count) AS whole,
                        count(DISTINCT s.node) AS n, bool_or(s.node = e.entity_id) AS with_first,
                        count(m.address) AS others
                 FROM side s JOIN ent e USING (address) JOIN size z USING (entity_id)
                 LEFT JOIN member m ON m.tx_hash = s.tx_hash AND m.address = s.node
                                   AND m.address <> s.address
                 GROUP BY s.tx_hash, s.address, e.entity_id)
           WHERE others = 0 AND n >= 2 AND whole - n >= 2""",
    ),
    "equal_output_transactions": _with(
        "outs ci",
        """SELECT tx_hash, value, equal_outputs, input_addresses
           FROM (SELECT tx_hash, value, count(*) AS equal_outputs
                 FROM (SELECT tx_hash, value - value % 10000000 AS value FROM outs WHERE value > 0)
                 GROUP BY tx_hash, value HAVING count(*) >= 2
                 QUALIFY row_number() OVER (PARTITION BY tx_hash ORDER BY count(*) DESC, value DESC) = 1)
           JOIN (SELECT tx_hash, count(DISTINCT address) AS input_addresses FROM ci GROUP BY tx_hash)
             USING (tx_hash)
           WHERE input_addresses >= 2""",
    ),
    "top_whale_members": _with(
        "ent ranked",
        """SELECT address, entity_id FROM ent
           WHERE entity_id IN (SELECT entity_id FROM ranked WHERE rank <= 10)""",
    ),
    "snapshot_results": _with("bal", "SELECT entity_id, balance_satoshi, utxo_count FROM bal"),
    "parquet_roundtrip": _with("utxo", f"SELECT {_OUTPUT_COLUMNS} FROM utxo"),
}
