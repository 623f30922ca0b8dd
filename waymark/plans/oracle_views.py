"""The annotation-shaped views in DuckDB SQL, written apart from the Spark ones."""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, needs: list[str], body: str) -> None:
    VIEWS[name] = needs, body


def sql(needs: list[str], body: str) -> str:
    """``body`` behind the views that it needs, each after those that it needs itself; a body
    that begins with a comma defines more views."""
    done: list[str] = []

    def add(name: str) -> None:
        for n in VIEWS[name][0]:
            add(n)
        if name not in done:
            done.append(name)

    for n in needs:
        add(n)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in done) + f"\n{body}"


view("tasks", [], """
  SELECT 0 AS src_idx, o_orderkey AS task_idx,
    CASE WHEN o_orderkey % 13 = 0 THEN 'http://v/video.mp4' ELSE printf('http://v/ep%05d.mp4', o_custkey) END AS video_url,
    CASE WHEN o_orderkey % 17 <> 0 THEN (5 + o_orderkey % 20)::DOUBLE + 0.75 END AS meta_duration,
    CASE WHEN o_orderkey % 34 = 0 THEN 7.0::DOUBLE END AS result_duration
  FROM orders""")
view("headers", ["tasks"], r"""
  SELECT src_idx, task_idx, CASE WHEN video_url LIKE '%/ep%' THEN regexp_extract(video_url, 'ep(\d+)', 1)::BIGINT END AS episode_id,
    video_url, (5 + task_idx % 20)::INT AS duration FROM tasks""")
view("keyrows", [], """
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 AS seq_idx
  FROM lineitem""")
view("keylabels", ["keyrows"], """
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'subtask' ELSE 'object' END AS kind, p_name AS text
  FROM keyrows JOIN part ON p_partkey = l_partkey WHERE seq_idx = 0""")
view("keyframes", ["keyrows", "keylabels"], """
  SELECT 0 AS src_idx, r.l_orderkey AS task_idx, r.l_linenumber AS result_idx, 0 AS label_idx, kind, text, seq_idx,
    (1 + l_partkey % 25)::INT AS frame,
    CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END AS enabled,
    l_quantity * 2 AS x, round_even(l_discount * 100, 0) * 10 AS y, round_even(l_tax * 100, 0) * 10 AS width, l_quantity AS height
  FROM keyrows r JOIN keylabels l ON r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber""")
view("instructions", [], """
  SELECT CASE WHEN o_custkey % 7 = 0 THEN -1 - o_custkey ELSE o_custkey END AS episode_id, CASE WHEN o_custkey % 11 = 0 THEN ''
    ELSE 'Walk past ' || upper(string_agg(DISTINCT p_name, ', ' ORDER BY p_name)) END AS text
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE l_linenumber = 1 GROUP BY o_custkey""")
view("told", ["headers", "instructions"], """
  SELECT h.*, coalesce(i.text, '') AS instruction FROM headers h LEFT JOIN instructions i ON h.episode_id = i.episode_id""")
view("ranges", ["keyframes", "headers"], """
  SELECT k.src_idx, k.task_idx, result_idx, label_idx, text,
    min(frame) FILTER (WHERE coalesce(enabled, true)) AS start_frame,
    coalesce(max(frame) FILTER (WHERE NOT coalesce(enabled, true)), any_value(duration)) AS end_frame
  FROM keyframes k JOIN headers h ON k.task_idx = h.task_idx WHERE kind = 'subtask'
  GROUP BY ALL HAVING start_frame IS NOT NULL""")
view("skeleton", ["headers"], """
  SELECT src_idx, task_idx, episode_id, unnest(range(1, duration + 1))::INT AS frame FROM headers""")
view("labelled", ["skeleton", "ranges"], """
  SELECT s.src_idx, s.task_idx, s.episode_id, s.frame,
    arg_max(r.text, r.result_idx * 1000 + r.label_idx) AS subtask
  FROM skeleton s LEFT JOIN ranges r ON s.task_idx = r.task_idx AND s.frame BETWEEN r.start_frame AND r.end_frame
  GROUP BY ALL""")
view("placed", ["keyframes", "headers"], """
  SELECT k.* FROM keyframes k JOIN headers h ON k.task_idx = h.task_idx
  WHERE kind = 'object' AND coalesce(enabled, true) AND frame BETWEEN 1 AND duration""")
view("placed_text", ["placed"], """
  SELECT task_idx, frame, count(*) AS n_objects,
    string_agg(text || '@' || x::BIGINT || ',' || y::BIGINT, '; ' ORDER BY result_idx, label_idx, seq_idx) AS objects
  FROM placed GROUP BY task_idx, frame""")
view("errors", ["told", "keyframes", "labelled"], """
  SELECT src_idx, task_idx, 0 AS phase, -1 AS result_idx, -1 AS label_idx, 0 AS frame, 'no_instruction' AS code,
    'Episode ' || coalesce(episode_id::VARCHAR, 'None') || ': 未找到原始指令' AS message
  FROM told WHERE instruction = ''
  UNION ALL
  SELECT k.src_idx, k.task_idx, 1, result_idx, label_idx, 0, 'not_in_instruction:' || kind,
    'Episode ' || coalesce(episode_id::VARCHAR, 'None') || ': ' || kind || ' ''' || text || ''' 不在原始指令中' || chr(10) || '  原指令: ' || instruction
  FROM (SELECT DISTINCT src_idx, task_idx, result_idx, label_idx, kind, text FROM keyframes) k JOIN told t ON k.task_idx = t.task_idx
  WHERE instruction <> '' AND NOT contains(lower(instruction), lower(text))
  UNION ALL
  SELECT src_idx, task_idx, 2, -1, -1, frame, 'no_subtask',
    'Episode ' || coalesce(episode_id::VARCHAR, 'None') || ', Frame ' || frame || ': 缺少subtask标注'
  FROM labelled WHERE subtask IS NULL""")
view("frames", [], """
  SELECT 0 AS src_idx, user_id AS task_idx, (row_number() OVER w - 1)::INT AS frame_pos, user_id AS episode_id,
    'Follow visitor ' || user_id || ' to the end.' AS instruction, (row_number() OVER w)::INT AS frame,
    CASE WHEN event_id % 7 <> 0 THEN 'go to ''' || event_type || '''' END AS subtask, event_id, event_type
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
view("objects", ["frames"], r"""
  SELECT *, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS label,
    greatest(0, least(1000, round_even(x * 10, 0)))::INT AS x1, greatest(0, least(1000, round_even(y * 10, 0)))::INT AS y1,
    greatest(0, least(1000, round_even((x + w) * 10, 0)))::INT AS x2, greatest(0, least(1000, round_even((y + h) * 10, 0)))::INT AS y2
  FROM (
    SELECT task_idx, frame_pos, event_id, 0 AS idx, event_type || ' door' AS raw, (event_id * 7 % 90)::DOUBLE AS x,
      (event_id * 13 % 90) + 0.25::DOUBLE AS y, (event_id % 17) + 0.5::DOUBLE AS w, (event_id % 11) + 0.25::DOUBLE AS h
    FROM frames WHERE event_id % 3 > 0
    UNION ALL
    SELECT task_idx, frame_pos, event_id, 1, '  the' || chr(9) || 'red   chair ', (event_id * 3 % 95) + 0.05::DOUBLE,
      (event_id * 5 % 95)::DOUBLE, (event_id % 23)::DOUBLE, (event_id % 9) + 0.75::DOUBLE
    FROM frames WHERE event_id % 3 = 2)""")
view("boxes", ["objects"], """
  SELECT *, (x1 + x2) / 2.0 AS cx, (y1 + y2) / 2.0 AS cy, '[' || x1 || ', ' || y1 || ', ' || x2 || ', ' || y2 || ']' AS box,
    CASE WHEN (x1 + x2) / 2.0 < 333 THEN 'left' WHEN (x1 + x2) / 2.0 > 667 THEN 'right' ELSE 'center' END AS hor,
    CASE WHEN (y1 + y2) / 2.0 < 333 THEN 'upper' WHEN (y1 + y2) / 2.0 > 667 THEN 'lower' ELSE 'middle' END AS ver
  FROM objects""")
view("zones", ["boxes"], """
  SELECT *, CASE WHEN hor = 'center' AND ver = 'middle' THEN 'center of the view' WHEN hor = 'center' THEN ver || ' center of the view'
    WHEN ver = 'middle' THEN hor || ' side of the view' ELSE ver || '-' || hor || ' area of the view' END AS zone FROM boxes""")
view("related", ["zones"], """
  SELECT o.*, f.label AS first_label, CASE WHEN o.cy - f.cy > 80 THEN 'below' WHEN f.cy - o.cy > 80 THEN 'above' END AS v,
    CASE WHEN o.cx - f.cx > 80 THEN 'right' WHEN f.cx - o.cx > 80 THEN 'left' END AS hh
  FROM zones o JOIN zones f ON o.event_id = f.event_id AND f.idx = 0""")
view("phrases", ["related"], """
  SELECT *, CASE WHEN v IS NULL AND hh IS NULL THEN 'near' WHEN v IS NULL THEN hh || ' of' WHEN hh IS NULL THEN v || ' of' ELSE v || '-' || hh || ' of' END AS relation
  FROM related""")
view("summaries", ["phrases", "frames"], """
  SELECT f.task_idx, f.frame_pos, count(idx) AS n_objects, max(raw) FILTER (WHERE idx = 0) AS first_raw, max(box) FILTER (WHERE idx = 0) AS first_box,
    coalesce(string_agg('''' || label || ''' at ' || box || ' (' || zone || ')' ||
      CASE WHEN idx = 0 THEN '' ELSE ', ' || relation || ' ''' || first_label || '''' END, '; ' ORDER BY idx), '[]') AS summary,
    CASE count(idx) WHEN 0 THEN 'no annotated objects' ELSE string_agg('''' || label || '''', ' and ' ORDER BY idx) END AS names,
    string_agg(label || ' ' || replace(box, ' ', ''), ' and ' ORDER BY idx) AS boxed, string_agg(label, ' and ' ORDER BY idx) AS labels
  FROM frames f LEFT JOIN phrases p ON f.event_id = p.event_id GROUP BY f.task_idx, f.frame_pos""")
view("truth", ["frames"], """
  SELECT (CASE WHEN episode_id % 10 = 3 THEN -1 - episode_id ELSE episode_id END)::VARCHAR AS episode_key,
    CASE WHEN episode_id % 4 = 1 THEN codes[1 : greatest(len(codes) - 5, 0)] ELSE codes END AS actions
  FROM (SELECT episode_id, list((event_id % 5)::INT ORDER BY frame_pos) AS codes FROM frames GROUP BY episode_id)""")
view("seen", ["frames"], """
  SELECT task_idx, list(subtask ORDER BY first_pos) AS subtasks FROM (
    SELECT task_idx, subtask, min(frame_pos) AS first_pos FROM frames WHERE subtask IS NOT NULL GROUP BY 1, 2) GROUP BY task_idx""")
view("eligible", ["frames", "truth", "seen", "summaries"], """
  SELECT f.*, subtasks, (list_position(subtasks, subtask) - 1)::INT AS completed, actions[frame] AS code,
    CASE actions[frame] WHEN 0 THEN 'STOP' WHEN 1 THEN 'MOVE_FORWARD' WHEN 2 THEN 'TURN_LEFT' WHEN 3 THEN 'TURN_RIGHT'
      ELSE 'UNKNOWN_' || actions[frame] END AS action, n_objects, summary, names, first_raw, first_box, boxed, labels
  FROM frames f JOIN truth t ON f.episode_id::VARCHAR = t.episode_key JOIN seen USING (task_idx)
    JOIN summaries s ON s.task_idx = f.task_idx AND s.frame_pos = f.frame_pos
  WHERE subtask IS NOT NULL AND frame <= len(actions)""")
view("worded", ["eligible"], """
  SELECT *, replace(lower(action), '_', ' ') AS phrase,
    '[' || array_to_string(list_transform(subtasks, lambda s: '"' || s || '"'), ', ') || ']' AS all_text,
    '[' || array_to_string(list_transform(subtasks[1 : completed], lambda s: '"' || s || '"'), ', ') || ']' AS done_text,
    'The agent is on ''' || subtask || ''', ' || CASE WHEN n_objects > 0 THEN 'sees ' || names || ',' ELSE 'no annotated object is visible,' END
      || ' and the action taken is ' || replace(lower(action), '_', ' ') || '.' AS facts
  FROM eligible""")
view("attempts", ["worded"], """
  SELECT *, CASE WHEN kind IN (0, 1, 2, 3, 13) OR (kind = 10 AND n_objects = 0) THEN NULL WHEN kind = 4 THEN 'missing:step3_decision_logic'
      WHEN kind = 5 THEN 'extra' WHEN kind = 6 THEN 'type:step1_task_progress' WHEN kind = 7 THEN 'blank:step2_spatial_perception'
      WHEN kind = 8 THEN 'long:step1_task_progress' WHEN kind = 9 THEN CASE WHEN n_objects > 0 THEN 'unseen' ELSE 'visible' END
      WHEN kind = 10 THEN 'bbox' WHEN kind = 11 THEN 'step3_action' WHEN kind = 12 THEN 'sentence' WHEN kind = 14 THEN 'json'
      WHEN kind = 15 THEN 'empty' WHEN kind = 16 THEN 'object' ELSE 'transport' END AS reason
  FROM (SELECT *, ((event_id + attempt * 5) % 18)::INT AS kind
        FROM (SELECT *, unnest(range(1, 2 + event_id % 3))::INT AS attempt FROM worded))""")
view("outcomes", ["attempts"], """
  SELECT task_idx, frame_pos, min(attempt) FILTER (WHERE reason IS NULL) AS attempt,
    CASE WHEN count(*) FILTER (WHERE reason IS NULL) > 0 THEN 'trace'
      WHEN count(*) FILTER (WHERE reason <> 'transport') > 0 THEN 'invalid' ELSE 'failed' END AS outcome
  FROM attempts GROUP BY task_idx, frame_pos""")
view("chain", ["worded", "outcomes"], """
  SELECT *, lag(anchor) OVER w AS memory, lag(frame) OVER w AS history_source_frame FROM (
    SELECT w.*, o.outcome, CASE WHEN outcome = 'trace' THEN 'Now ' || phrase || ' at ' || event_id || '.' ELSE facts END AS anchor
    FROM worded w JOIN outcomes o ON w.task_idx = o.task_idx AND w.frame_pos = o.frame_pos)
  WINDOW w AS (PARTITION BY task_idx ORDER BY frame_pos)""")
view("vertices", [], """
  SELECT printf('s%03d.v1', label) AS scene, vec_id AS vertex_id, round(embedding[1]::DOUBLE * 10, 3) AS x,
    round(embedding[2]::DOUBLE * 10, 3) AS y, round(embedding[3]::DOUBLE * 10, 3) AS z FROM embeddings""")
view("faces", ["vertices"], """
  SELECT * FROM (SELECT scene, vertex_id AS face_id, vertex_id AS v0, lead(vertex_id, 1) OVER w AS v1, lead(vertex_id, 2) OVER w AS v2
    FROM vertices WINDOW w AS (PARTITION BY scene ORDER BY vertex_id)) WHERE v2 IS NOT NULL""")
view("places", [], """
  SELECT vec_id AS episode_id, vec_id * 2 AS trajectory_id, printf('s%03d.v1', label) AS scene, k,
    round(embedding[k + 1]::DOUBLE * 5, 3) AS px, round(embedding[k + 2]::DOUBLE * 5, 3) AS py, round(embedding[k + 3]::DOUBLE * 5, 3) AS pz
  FROM embeddings, (SELECT unnest([3, 6, 9]) AS k)""")
view("crops", ["places"], """
  SELECT episode_id, trajectory_id, scene, min(px) - 3 AS low_x, max(px) + 3 AS high_x, min(-pz) - 3 AS low_y, max(-pz) + 3 AS high_y,
    min(py) - 3 AS low_z, max(py) + 2.5 AS high_z
  FROM places GROUP BY ALL""")
view("kept", ["vertices", "crops"], """
  SELECT episode_id, v.scene, vertex_id, x, y, z FROM vertices v JOIN crops b ON v.scene = b.scene
    AND x BETWEEN low_x AND high_x AND y BETWEEN low_y AND high_y AND z BETWEEN low_z AND high_z""")
view("kept_faces", ["kept", "faces"], """
  SELECT a.episode_id, f.scene, face_id FROM faces f JOIN kept a ON f.scene = a.scene AND f.v0 = a.vertex_id
    JOIN kept b ON b.episode_id = a.episode_id AND b.vertex_id = f.v1 JOIN kept c ON c.episode_id = a.episode_id AND c.vertex_id = f.v2""")
view("chats", [], """
  SELECT conv_id AS record_idx, conv_id % 50 AS episode_id, (1 + conv_id % 9)::INT AS frame,
    CASE WHEN conv_id % 4 <> 0 THEN 'memory ' || conv_id END AS memory, CASE WHEN conv_id % 5 <> 0 THEN conv_id % 7 END AS history_source_frame,
    CASE WHEN conv_id % 3 <> 0 AND count(*) FILTER (WHERE role = 'user') > 0 THEN 'f/' || conv_id || '.jpg' END AS image_path,
    arg_min(text, turn) FILTER (WHERE role = 'user') AS prompt,
    coalesce(arg_min(text, turn) FILTER (WHERE role = 'assistant'), '') AS answer
  FROM conversations GROUP BY conv_id""")
