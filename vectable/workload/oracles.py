"""The same results in DuckDB SQL over the source tables."""

from __future__ import annotations


def _int32(number: str) -> str:
    return f"CAST(({number} + 2147483648) % 4294967296 - 2147483648 AS INTEGER)"


def _rounded(mantissa_bits: int, lowest: int) -> str:
    """x rounded to a shorter binary fraction, ties to even."""
    scale = f"pow(2.0, {mantissa_bits} - greatest(floor(log2(abs(x))), {lowest}))"
    return f"CASE WHEN x = 0 THEN 0.0 ELSE round_even(x * {scale}, 0) / {scale} END"


def _pattern(mantissa_bits: int, lowest: int) -> str:
    """The bit pattern of that value: sign, exponent and fraction as one unsigned number."""
    exponent = f"greatest(floor(log2(abs(x))), {lowest})"
    steps = f"round_even(abs(x) * pow(2.0, {mantissa_bits} - {exponent}), 0)"
    size = f"({exponent} - {lowest}) * {2**mantissa_bits} + {steps}"
    return f"CAST(CASE WHEN x = 0 THEN 0 ELSE {size} + CASE WHEN x < 0 THEN 32768 ELSE 0 END END AS BIGINT)"


FP16 = (10, -14)
BF16 = (7, -126)


def _sum(values: str) -> str:
    return f"round(list_sum({values}), 6)"


def _halves(values: str, form: tuple[int, int]) -> str:
    return f"[{_rounded(*form)} FOR x IN {values}]"


def _doubles(values: str) -> str:
    return f"CAST({values} AS DOUBLE[])"


def _byte(first: int) -> str:
    terms = " + ".join(f"CASE WHEN e[{first + i}] > 0 THEN {1 << (7 - i)} ELSE 0 END" for i in range(8))
    return f"({terms})"


HELLO = f"""
WITH hello AS (
  SELECT v AS id, v % 2 = 0 AS f2, CAST(v % 256 - 128 AS TINYINT) AS f3,
    CAST((v * 131) % 65536 - 32768 AS SMALLINT) AS f4, {_int32("v * 7919 - 1000000")} AS f5,
    v * 1000003 AS f6, CAST(e[1] AS DOUBLE) AS f7, CAST(e[2] AS DOUBLE) AS f8, 'vec-' || v AS f9,
    ['string-' || v || '-' || k FOR k IN range(0, 5 + v % 5)] AS f10,
    [{_int32("v * k - 100")} FOR k IN range(0, 5 + v % 5)] AS f10_2,
    CASE WHEN v % 11 <> 0 THEN '{{"path":"root/abc/path' || v || '","size":' || v
      || CASE WHEN v % 7 = 0 THEN ',"special":true' ELSE '' END
      || ',"flags":[' || v || ',' || (v + 1) || ',' || (v + 2) || ']}}' END AS f11,
    {_doubles("e")} AS dense,
    array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN e], '') AS bits,
    [{", ".join(_byte(8 * i + 1) for i in range(8))}] AS bytes,
    [i * 15013 + v % 7 FOR i IN range(0, len(e))] AS sparse_keys,
    {_doubles("e")} AS sparse_values,
    CASE WHEN label < 5 THEN '_default' ELSE 'p' || label END AS __partition
  FROM (SELECT vec_id AS v, embedding AS e, label FROM embeddings)
)
"""

_SCALARS = "id, f2, f3, f4, f5, f6, round(f7, 6) AS f7, round(f8, 6) AS f8, f9"
_ARRAYS = "array_to_string(f10, '|') AS f10, array_to_string(f10_2, '|') AS f10_2"
_VECTORS = f"""{_sum("dense")} AS dense_sum, bits, array_to_string(sparse_keys, '|') AS sparse_keys,
  {_sum("sparse_values")} AS sparse_sum, {_sum(_halves("dense", FP16))} AS fp16_sum"""
_BF16_SUM = f"{_sum(_halves('dense', BF16))} AS bf16_sum"
_FLAT = f"{_SCALARS}, {_ARRAYS}, f11, {_VECTORS}, {_BF16_SUM}"


def _hello(columns: str, rest: str = "") -> str:
    return f"{HELLO} SELECT {columns} FROM hello {rest}"


def _per_partition(times: int = 1, more: str = "") -> str:
    return _hello(
        f"__partition, CAST(count(*) * {times} AS BIGINT) AS row_count, count(DISTINCT id) AS ids,"
        f" CAST(sum(f6) * {times} AS BIGINT) AS f6_sum{more}",
        "GROUP BY __partition",
    )


def _elements(values: str) -> str:
    return f"""{HELLO}, listed AS (SELECT id, {values} AS vals FROM hello)
    SELECT id, CAST(n AS INTEGER) AS pos, round(CAST(vals[n + 1] AS DOUBLE), 6) AS value
    FROM (SELECT id, vals, unnest(range(0, len(vals))) AS n FROM listed)"""


def _encoded(form: tuple[int, int]) -> str:
    return f"""
    WITH coded AS (SELECT vec_id AS id, [{_pattern(*form)} FOR x IN CAST(embedding AS DOUBLE[])] AS p FROM embeddings),
    spread AS (SELECT id, len(p) AS dim, unnest(p) AS bits, unnest(range(0, len(p))) AS n FROM coded)
    SELECT id, CAST(2 * max(dim) AS INTEGER) AS byte_count,
      CAST(sum((bits & 255) * (2 * n + 1) + (bits >> 8) * (2 * n + 2)) AS BIGINT) AS checksum
    FROM spread GROUP BY id"""


def _decoded(form: tuple[int, int]) -> str:
    return f"""
    WITH coded AS (SELECT vec_id AS id, {_halves("CAST(embedding AS DOUBLE[])", form)} AS vals FROM embeddings)
    SELECT id, CAST(len(vals) AS INTEGER) AS dim, {_sum("vals")} AS total,
      round(list_min(vals), 6) AS low, round(list_max(vals), 6) AS high FROM coded"""


def _nearest(scored: str, order: str = "DESC") -> str:
    """Top five by score for the first row of each partition."""
    return f"""{HELLO}, asked AS (
      SELECT * FROM hello QUALIFY row_number() OVER (PARTITION BY __partition ORDER BY id) = 1
    ), scored AS ({scored}), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) {order}, id) AS place FROM scored
    )
    SELECT query_id, CAST(place AS INTEGER) AS rank, id, round(score, 6) AS score FROM ranked WHERE place <= 5"""


def _cosine(vector: str) -> str:
    return _nearest(f"""
      SELECT a.__partition AS query_id, h.id,
        list_sum([x.p * x.q FOR x IN list_transform(range(1, len(h.vec) + 1), lambda n: {{'p': h.vec[n], 'q': a.vec[n]}})])
        / sqrt(list_sum([x * x FOR x IN h.vec])) / sqrt(list_sum([x * x FOR x IN a.vec])) AS score
      FROM (SELECT *, {vector} AS vec FROM asked) a, (SELECT *, {vector} AS vec FROM hello) h""")


_LINE_TOTALS = """
SELECT l_returnflag AS __partition, l_linestatus, count(*) AS row_count, round(sum(l_quantity), 2) AS quantity,
  round(sum(l_extendedprice), 2) AS price, strftime(min(l_shipdate), '%Y-%m-%d') AS first_shipped,
  strftime(max(l_shipdate), '%Y-%m-%d') AS last_shipped
FROM lineitem GROUP BY l_returnflag, l_linestatus"""

# The columns of the HELLO collection as a read shows them.
HELLO_COLUMNS = [
    ("id", "bigint", "row number"),
    ("f2", "boolean", ""),
    ("f3", "tinyint", ""),
    ("f4", "smallint", ""),
    ("f5", "int", ""),
    ("f6", "bigint", ""),
    ("f7", "float", "first coordinate"),
    ("f8", "double", ""),
    ("f9", "string", ""),
    ("f10", "array<string>", ""),
    ("f10_2", "array<int>", ""),
    ("f11", "string", "free-form attributes"),
    ("vec_dense", "array<float>", ""),
    ("vec_binary", "array<tinyint>", ""),
    ("vec_sparse", "map<bigint,float>", ""),
    ("vec_fp16", "array<tinyint>", ""),
    ("vec_bf16", "array<tinyint>", ""),
    ("__partition", "string", ""),
]

_NAMES = [name for name, _, _ in HELLO_COLUMNS]
_DESCRIBED = ", ".join(
    f"({i}, '{name}', '{kind}', {str(name == 'f11').lower()}, '{comment}')"
    for i, (name, kind, comment) in enumerate(HELLO_COLUMNS)
)


def oracles() -> dict[str, str]:
    """DuckDB SQL by query name."""
    flat = _hello(f"{_FLAT}, __partition")
    lines = "FROM lineitem"
    events = """FROM events GROUP BY event_type"""
    event_sums = """SELECT event_type AS __partition, count(*) AS row_count,
      CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, round(sum(value), 2) AS value_sum,
      strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts"""
    return {
        "scan_collection": flat,
        "scan_partition_tag": _hello("id, __partition"),
        "scan_one_partition": _hello("id, f9, __partition", "WHERE __partition = 'p7'"),
        "batch_plan": _hello(
            "__partition, count(*) AS row_count, CAST(ceil(count(*) / 100.0) AS BIGINT) AS batches",
            "GROUP BY __partition",
        ),
        "batch_scan": f"""{HELLO}, sizes AS (SELECT count(*) AS n FROM hello GROUP BY __partition)
          SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(ceil(n / 100.0)) AS BIGINT) AS batches, true AS bounded
          FROM sizes""",
        "batch_addresses": _hello(
            "__partition, CAST(count(*) AS BIGINT) AS row_count, true AS found, true AS bounded", "GROUP BY __partition"
        ),
        "scan_hides_function_output": _hello(
            f"id, {_ARRAYS}, {_VECTORS}, {_BF16_SUM}, CAST(18 AS INTEGER) AS column_count, false AS shown"
        ),
        "scan_field_order": _hello(f"{_FLAT}, __partition, '{','.join(_NAMES)}' AS column_names"),
        "has_collection": "SELECT count(*) AS row_count, true AS present, false AS absent_present FROM embeddings",
        "describe_collection": f"""
          SELECT position, name, type, nullable, comment, CASE WHEN name = 'f11'
            THEN (SELECT count(*) FROM embeddings WHERE vec_id % 11 <> 0)
            ELSE (SELECT count(*) FROM embeddings) END AS value_count
          FROM (VALUES {_DESCRIBED}) AS t(position, name, type, nullable, comment)""",
        "list_partitions": _hello("DISTINCT __partition"),
        "list_function_outputs": "SELECT 'sparse_out' AS function_outputs, count(*) AS row_count FROM embeddings",
        "sql_table_scan": _per_partition(),
        "sql_limit": _hello("id, f2, f5, f9, f11, __partition", "ORDER BY id LIMIT 10"),
        "option_read": _hello("id, f9, __partition", "WHERE __partition = 'p7'"),
        "option_append": "SELECT 2 * count(*) AS row_count, 2 * count(*) AS ids, true AS bounded FROM embeddings",
        "create_collection": _per_partition(),
        "append_roundtrip": _per_partition(2),
        "append_routing": _hello(
            "__partition, count(*) AS row_count, min(id) AS first_id, max(id) AS last_id, true AS in_its_directory",
            "GROUP BY __partition",
        ),
        "append_batches": _hello("__partition, count(*) AS row_count, true AS bounded", "GROUP BY __partition"),
        "append_auto_id": """SELECT 2 * count(*) AS row_count, 2 * count(*) AS ids,
          count(DISTINCT vec_id) AS inputs FROM embeddings""",
        "append_skips_function_output": _per_partition(more=", false AS stored"),
        "to_entities": _hello(
            f"""id, '{",".join(_NAMES[:-1])}' AS names, CAST(f2 AS VARCHAR) AS f2, f9, f10[2] AS second_text,
            f10_2[4] AS fourth_number, f11, round(dense[64], 6) AS last_dense,
            CAST(CASE WHEN bytes[1] > 127 THEN bytes[1] - 256 ELSE bytes[1] END AS INTEGER) AS first_byte,
            CAST(128 AS INTEGER) AS fp16_bytes, array_to_string(sparse_keys, '|') AS sparse_keys, __partition"""
        ),
        "from_entities": flat,
        "copy_collection": flat,
        "insert_generated": """SELECT '_default' AS __partition, count(*) AS row_count,
          count(DISTINCT o_orderkey) AS ids, CAST(8 AS INTEGER) AS dense_size, CAST(2 AS INTEGER) AS binary_size,
          CAST(32 AS INTEGER) AS fp16_size FROM orders""",
        "types_scalar": _hello(_SCALARS),
        "types_nulls": "SELECT vec_id AS id, "
        + ", ".join(
            f"vec_id % 17 = {i}{' OR vec_id % 11 = 0' if name == 'f11' else ''} AS {name}"
            for i, name in enumerate(_NAMES[:-1])
            if i
        )
        + " FROM embeddings",
        "types_json": _hello(
            """id, json_extract_string(f11, '$.path') AS path,
            CAST(json_extract_string(f11, '$.size') AS BIGINT) AS size,
            json_extract_string(f11, '$.special') AS special,
            CAST(json_extract_string(f11, '$.flags[2]') AS BIGINT) AS last_flag"""
        ),
        "types_array": _hello(
            """id, f2 || '|' || (NOT f2) AS a_bool,
            f3 || '|' || (-CAST(f3 AS INTEGER) - 1) AS a_int8, f4 || '|' || (-CAST(f4 AS BIGINT) - 1) AS a_int16,
            f5 || '|' || (-CAST(f5 AS BIGINT)) AS a_int32, f6 || '|' || (-f6) AS a_int64,
            f9 || '|' || upper(f9) AS a_string, f9 || '|' || f9 || '!' AS a_varchar,
            round(f7, 6) AS a_float_0, round(f8, 6) AS a_float_1, round(f8, 6) AS a_double_0, round(-f8, 6) AS a_double_1"""
        ),
        "types_float_vector": _elements("dense"),
        "types_binary_vector": _elements("[CASE WHEN b > 127 THEN b - 256 ELSE b END FOR b IN bytes]"),
        "types_fp16_vector": _elements(_halves("dense", FP16)),
        "types_bf16_vector": _elements(_halves("dense", BF16)),
        "types_sparse_vector": f"""{HELLO}
          SELECT id, CAST(n AS INTEGER) AS pos, sparse_keys[n + 1] AS key, round(sparse_values[n + 1], 6) AS value
          FROM (SELECT *, unnest(range(0, len(sparse_keys))) AS n FROM hello)""",
        "encode_fp16": _encoded(FP16),
        "encode_bf16": _encoded(BF16),
        "decode_fp16": _decoded(FP16),
        "decode_bf16": _decoded(BF16),
        "binary_bits": _hello("id, bits, CAST(length(replace(bits, '0', '')) AS INTEGER) AS ones"),
        "gen_float_vectors": f"""SELECT count(*) AS vectors, CAST(8 AS INTEGER) AS min_size,
          CAST(8 AS INTEGER) AS max_size, true AS in_range, true AS centred {lines}""",
        "gen_constant_vectors": f"""SELECT count(*) AS vectors, CAST(8 AS INTEGER) AS min_size,
          CAST(8 AS INTEGER) AS max_size, true AS in_range {lines}""",
        "gen_binary_vectors": f"""SELECT count(*) AS vectors, CAST(2 AS INTEGER) AS min_size,
          CAST(2 AS INTEGER) AS max_size, true AS in_range, true AS both_signs {lines}""",
        "gen_sparse_vectors": f"""SELECT count(*) AS vectors, true AS in_range, true AS min_fits,
          true AS max_fits {lines}""",
        "gen_half_vectors": f"""SELECT count(*) AS vectors, CAST(32 AS INTEGER) AS fp16_size,
          CAST(32 AS INTEGER) AS bf16_size, true AS in_range {lines}""",
        "count_collection": "SELECT count(*) AS row_count FROM embeddings",
        "project_limit": _hello(f"{_SCALARS}, {_ARRAYS}, f11, {_VECTORS}", "ORDER BY id LIMIT 5"),
        "project_vectors": _hello(
            f"id, {_sum('dense')} AS dense_sum, bits, {_sum(_halves('dense', FP16))} AS fp16_sum",
            "ORDER BY id LIMIT 5",
        ),
        "topk_cosine": _cosine("dense"),
        "topk_cosine_blocks": _cosine("dense"),
        "topk_cosine_fp16": _cosine(_halves("dense", FP16)),
        "topk_cosine_bf16": _cosine(_halves("dense", BF16)),
        "topk_hamming": _nearest(
            """SELECT a.__partition AS query_id, h.id, CAST(list_sum([bit_count(xor(a.bytes[n], h.bytes[n]))
              FOR n IN range(1, 9)]) AS DOUBLE) AS score FROM asked a, hello h""",
            "ASC",
        ),
        "topk_sparse_ip": _nearest(
            """SELECT a.__partition AS query_id, h.id, sum(a.value * h.value) AS score
            FROM (SELECT __partition, unnest(sparse_keys) AS key, unnest(sparse_values) AS value FROM asked) a
            JOIN (SELECT id, unnest(sparse_keys) AS key, unnest(sparse_values) AS value FROM hello) h
            ON a.key = h.key GROUP BY a.__partition, h.id"""
        ),
        "host_surface_smoke": _hello(
            "__partition, label, count(*) AS row_count, round(sum(f8), 6) AS f8_sum",
            "JOIN embeddings ON vec_id = id WHERE f8 > 0 GROUP BY __partition, label",
        ),
        "scan_lineitem": _LINE_TOTALS,
        "append_lineitem": _LINE_TOTALS,
        "copy_lineitem": _LINE_TOTALS,
        "scan_events_json": f"{event_sums} {events}",
        "entities_events": f"{event_sums}, CAST(sum(event_id) AS BIGINT) AS event_ids {events}",
    }
