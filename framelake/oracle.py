"""DuckDB twins of the fixture adapters, for the SQL oracle.

Each oracle query is plain SQL over the driver's base tables; fixture views
are inlined as CTEs so the oracle sees exactly the inputs the Spark side
derives in :mod:`framelake.sources.testdata`.  DuckDB literals such as
``0.8`` are DECIMAL, so every float literal here is written as a DOUBLE.
"""

from __future__ import annotations

FX: dict[str, str] = {
    "fx_frames": """
        SELECT user_id % 4 AS video_id, event_id AS frame_id,
               epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS pts_us,
               CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'B' ELSE 'P' END AS pict_type,
               CAST(floor(value * 1000) AS BIGINT) AS size_bytes
        FROM events""",
    "fx_pixels": """
        SELECT label AS video_id, vec_id AS frame_no,
               CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x,
               CAST(floor(least(255.0::DOUBLE, greatest(0.0::DOUBLE,
                    128.0::DOUBLE + 256.0::DOUBLE * CAST(embedding[i + 1] AS DOUBLE)))) AS BIGINT) AS v,
               CAST(embedding[i + 1] AS DOUBLE) AS e
        FROM embeddings, (SELECT unnest(range(64)) AS i) r""",
    "fx_arrays": """
        SELECT label AS video_id, vec_id AS frame_no,
               list_transform(embedding, lambda e: CAST(floor(least(255.0::DOUBLE, greatest(0.0::DOUBLE,
                    128.0::DOUBLE + 256.0::DOUBLE * CAST(e AS DOUBLE)))) AS BIGINT)) AS vals
        FROM embeddings""",
    "fx_bgr": """
        SELECT video_id, frame_no, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x,
               CAST(c AS INTEGER) AS c, vals[(i + 21 * c) % 64 + 1] AS v
        FROM fx_arrays, (SELECT unnest(range(64)) AS i) r, (SELECT unnest(range(3)) AS c) k""",
    "fx_template": """
        SELECT y - 2 AS ty, x - 2 AS tx, v AS t FROM fx_pixels
        WHERE frame_no = 0 AND y BETWEEN 2 AND 4 AND x BETWEEN 2 AND 4""",
    "fx_logo": """
        SELECT y AS ly, x AS lx, v AS l,
               CAST(CASE x WHEN 0 THEN 0 WHEN 1 THEN 128 ELSE 255 END AS BIGINT) AS a
        FROM fx_pixels WHERE frame_no = 1 AND y < 3 AND x < 3""",
    "fx_payload": """
        SELECT doc_id % 4 AS video_id, CAST(doc_id // 4 AS BIGINT) AS chunk_id,
               encode(text) AS payload
        FROM documents""",
    "fx_packets": """
        SELECT user_id % 4 AS video_id,
               CASE WHEN event_type = 'purchase' AND user_id % 4 <> 3 THEN 'audio'
                    WHEN event_type IN ('view', 'click') THEN 'video'
                    WHEN event_type = 'signup' THEN 'subtitle' ELSE 'data' END AS media_type,
               epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS pts_us,
               event_id AS packet_id, encode(props) AS payload
        FROM events""",
    "fx_probe": """
        SELECT video_id, fps_text,
          '{"streams":[{"index":0,"codec_type":"audio","sample_rate":"48000"},'
          || '{"index":1,"codec_type":"video","width":' || CAST((p_size + 40) * 16 AS VARCHAR)
          || ',"height":' || CAST((p_size + 40) * 9 AS VARCHAR)
          || ',"avg_frame_rate":"' || fps_text
          || '","nb_frames":"' || CAST(p_size * 300 + p_partkey % 7 AS VARCHAR)
          || '","duration":"' || CAST(p_retailprice AS VARCHAR)
          || '"}],"format":{"duration":"' || CAST(p_retailprice AS VARCHAR)
          || '","size":"' || CAST(p_partkey * 1000 + 5000000 AS VARCHAR)
          || '","bit_rate":"' || CAST(p_size * 100000 AS VARCHAR) || '"}}' AS probe_json
        FROM (SELECT p_partkey AS video_id, p_partkey, p_size, p_retailprice,
                     CASE p_partkey % 100 WHEN 0 THEN '0/0' WHEN 1 THEN 'abc' WHEN 2 THEN '25'
                          ELSE CAST(p_size * 1000 AS VARCHAR) || '/1001' END AS fps_text
              FROM part) p""",
    "fx_resources": """
        SELECT user_id % 4 AS run_id, ts, floor(value * 0.8::DOUBLE) / 4.0::DOUBLE AS cpu_percent,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ram_percent
        FROM events""",
    "fx_runs": """
        SELECT l_suppkey AS run_id, l_orderkey AS item_id, l_linenumber AS item_no,
               CAST(floor(l_extendedprice) AS DOUBLE) AS in_bytes, l_quantity * 1000 AS out_bytes,
               l_returnflag <> 'R' AS ok, l_shipdate AS ts, l_linestatus AS phase_flag
        FROM lineitem""",
    "fx_coo": """
        SELECT l_orderkey % 50 AS i, l_partkey % 50 AS j, sum(l_quantity) AS v
        FROM lineitem GROUP BY 1, 2""",
}

# Fixture dependencies: a fixture's CTE must come after the ones it reads.
_DEPS = {"fx_template": ["fx_pixels"], "fx_logo": ["fx_pixels"], "fx_bgr": ["fx_arrays"]}


def with_fx(sql: str, *names: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of the named fixtures (plus extra CTEs)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({FX[n]})" for n in order]
    parts += [f"{n} AS ({q})" for n, q in (ctes or [])]
    return ("WITH " + ",\n".join(parts) + "\n" + sql) if parts else sql
