"""The registered queries in SQL, over the same tables. Written independently of the library."""

from __future__ import annotations

from playledger.testbed.views import (
    EMPTY_WEEK,
    EVENTS_END,
    EVENTS_WEEK,
    LINEITEM_DAYS,
    LINEITEM_END,
    LINEITEM_PAST,
    LINEITEM_WEEK,
)
from playledger.testbed.queries import BEFORE, CURSOR_MS, CUTS, DELAY, LATE_CURSOR_MS, REPORT_DATES, WAIT

SONG_ID = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

LINEITEM_FACT = """(SELECT l_partkey AS song_id, l_orderkey AS album_id, l_suppkey AS artist_id,
    l_shipdate AS played_at FROM lineitem)"""
EVENTS_FACT = f"""(SELECT {SONG_ID} AS song_id, user_id AS album_id, {SONG_ID} % 10 AS artist_id,
    ts AS played_at FROM events)"""
SONG = "(SELECT p_partkey AS song_id, p_name AS song_name, p_size * 10000 AS duration_ms FROM part)"
ALBUM = """(SELECT o_orderkey AS album_id, o_orderpriority AS album, o_orderstatus AS album_art
    FROM orders)"""
ARTIST = "(SELECT s_suppkey AS artist_id, s_name AS artist FROM supplier)"

# As the payload views and the play time text make them.
PAYLOAD_ALBUM = """(SELECT o_orderkey AS album_id, o_orderpriority AS album,
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'https://music.example/image/' || o_orderstatus END
        AS album_art FROM orders)"""
PAGE_PLAYS = f"""(SELECT {SONG_ID} AS song, user_id, event_type, ts FROM events
    UNION ALL SELECT ({SONG_ID} + 1) % 100, user_id, event_type, ts FROM events
    WHERE event_type = 'click')"""
PAYLOAD_FACT = f"""(SELECT song AS song_id, user_id AS album_id,
    CASE WHEN event_type <> 'error' THEN song % 10 END AS artist_id,
    date_trunc('milliseconds', ts) AS played_at FROM {PAGE_PLAYS} p)"""

PLAYED_AT_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def _week(as_of: str) -> tuple[str, str]:
    monday = f"date_trunc('week', TIMESTAMP '{as_of} 00:00:00')"
    return (
        f"{monday} - INTERVAL '1' DAY + INTERVAL '1' MINUTE",
        f"{monday} + INTERVAL '5' DAY + INTERVAL '8' HOUR + INTERVAL '59' MINUTE",
    )


def _in_week(as_of: str) -> str:
    start, end = _week(as_of)
    return f"f.played_at >= {start} AND f.played_at < {end}"


MINUTES = "CAST(floor(sum(s.duration_ms) / 60000.0) AS BIGINT)"
JOIN_SONG = f"JOIN {SONG} s ON f.song_id = s.song_id"


def _songs(fact: str, as_of: str, album: str = ALBUM) -> str:
    return f"""SELECT song_name, album, artist, album_art, {MINUTES} AS total_minute_listened
        FROM {fact} f {JOIN_SONG} JOIN {album} a ON f.album_id = a.album_id
        JOIN {ARTIST} r ON f.artist_id = r.artist_id WHERE {_in_week(as_of)}
        GROUP BY ALL ORDER BY total_minute_listened DESC NULLS LAST, song_name NULLS FIRST,
        album NULLS FIRST, artist NULLS FIRST, album_art NULLS FIRST LIMIT 10"""


def _albums(fact: str, as_of: str, album: str = ALBUM) -> str:
    return f"""SELECT album, artist, album_art, {MINUTES} AS total_minute_listened
        FROM {fact} f {JOIN_SONG} JOIN {album} a ON f.album_id = a.album_id
        JOIN {ARTIST} r ON f.artist_id = r.artist_id WHERE {_in_week(as_of)}
        GROUP BY ALL ORDER BY total_minute_listened DESC NULLS LAST,
        album NULLS FIRST, artist NULLS FIRST, album_art NULLS FIRST LIMIT 5"""


def _artists(fact: str, as_of: str) -> str:
    return f"""SELECT artist, {MINUTES} AS total_minute_listened
        FROM {fact} f {JOIN_SONG} JOIN {ARTIST} r ON f.artist_id = r.artist_id
        WHERE {_in_week(as_of)}
        GROUP BY ALL ORDER BY total_minute_listened DESC NULLS LAST, artist NULLS FIRST LIMIT 5"""


def _forgotten(fact: str, as_of: str, album: str = ALBUM) -> str:
    return f"""SELECT song_name, album_art, max(f.played_at) AS last_played,
        CAST(datediff('day', CAST(max(f.played_at) AS DATE), DATE '{as_of}') AS INTEGER) AS days_ago
        FROM {fact} f {JOIN_SONG} JOIN {album} a ON f.album_id = a.album_id
        WHERE CAST(f.played_at AS DATE) <= DATE '{as_of}'
        GROUP BY song_name, album_art
        ORDER BY days_ago DESC NULLS LAST, song_name NULLS FIRST, album_art NULLS FIRST LIMIT 10"""


def _suite(fact: str, as_of: str, album: str = ALBUM) -> str:
    minutes = "total_minute_listened DESC NULLS LAST"

    def part(number: int, name: str, order: str, columns: str, rows: str) -> str:
        name = name.replace("'", "''")
        return f"""SELECT '{as_of}' AS as_of, {number} AS section_no, '{name}' AS section,
            CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, {columns}
            FROM ({rows}) q{number}"""

    blank = "CAST(NULL AS VARCHAR)"
    no_last = "CAST(NULL AS TIMESTAMP) AS last_played, CAST(NULL AS INTEGER) AS days_ago"
    return " UNION ALL ".join(
        [
            part(1, "Top 10 Songs",
                 f"{minutes}, song_name NULLS FIRST, album NULLS FIRST, artist NULLS FIRST, "
                 "album_art NULLS FIRST",
                 f"song_name, album, artist, album_art, total_minute_listened, {no_last}",
                 _songs(fact, as_of, album)),
            part(2, "Top 5 Albums",
                 f"{minutes}, album NULLS FIRST, artist NULLS FIRST, album_art NULLS FIRST",
                 f"{blank} AS song_name, album, artist, album_art, total_minute_listened, "
                 f"{no_last}",
                 _albums(fact, as_of, album)),
            part(3, "Top 5 Artists", f"{minutes}, artist NULLS FIRST",
                 f"{blank} AS song_name, {blank} AS album, artist, {blank} AS album_art, "
                 f"total_minute_listened, {no_last}",
                 _artists(fact, as_of)),
            part(4, "Songs you haven't listened to in a while",
                 "days_ago DESC NULLS LAST, song_name NULLS FIRST, album_art NULLS FIRST",
                 f"song_name, {blank} AS album, {blank} AS artist, album_art, "
                 "CAST(NULL AS BIGINT) AS total_minute_listened, last_played, days_ago",
                 _forgotten(fact, as_of, album)),
        ]
    )


def _suite_text(fact: str, as_of: str, album: str = ALBUM) -> str:
    return f"""SELECT as_of, section_no, section, rank, song_name, album, artist, album_art,
        CAST(total_minute_listened AS VARCHAR) AS total_minute_listened, last_played,
        CAST(days_ago AS VARCHAR) AS days_ago FROM ({_suite(fact, as_of, album)}) suite"""


# --- payloads and topics ------------------------------------------------------------------------

SONG_ROWS = """SELECT CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title,
    p_size % 3 + 1 AS disc_number, p_size * 10000 AS duration_ms, p_size % 2 = 0 AS explicit,
    'https://music.example/song/' || p_partkey AS external_url,
    CASE p_size % 3 WHEN 0 THEN 'No preview available'
        WHEN 2 THEN 'https://music.example/preview/' || p_partkey END AS preview_url,
    p_size AS popularity FROM part"""

RELEASE_TEXT = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y')
    WHEN 'O' THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
RELEASE_DAY = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-01-01')
    WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-01') ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


def _album_rows(release: str) -> str:
    return f"""SELECT CAST(o_orderkey AS VARCHAR) AS album_id, o_orderpriority AS title,
        CAST(o_custkey % 20 + 1 AS INTEGER) AS total_tracks, {release} AS release_date,
        'https://music.example/album/' || o_orderkey AS external_url,
        CASE WHEN o_orderpriority <> '5-LOW'
            THEN 'https://music.example/image/' || o_orderstatus END AS image_url,
        'label ' || o_orderpriority AS label,
        CAST(o_custkey % 101 AS INTEGER) AS popularity FROM orders"""


ARTIST_ROWS = """SELECT CAST(s_suppkey AS VARCHAR) AS artist_id, s_name AS name,
    'https://music.example/artist/' || s_suppkey AS external_url,
    CAST(s_suppkey * 7 AS INTEGER) AS follower_count,
    'https://music.example/portrait/' || s_nationkey AS image_url,
    s_nationkey AS popularity FROM supplier"""

PLAYS = f"""SELECT CAST(song AS VARCHAR) AS song_id, CAST(user_id AS VARCHAR) AS album_id,
    CASE WHEN event_type <> 'error' THEN CAST(song % 10 AS VARCHAR) END AS artist_id,
    {PLAYED_AT_TEXT} AS played_at FROM {PAGE_PLAYS} p"""

NEW_SONGS = """SELECT DISTINCT l_partkey AS song_id FROM lineitem WHERE NOT EXISTS
    (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_type <> 'PROMO')"""
NEW_ALBUMS = """SELECT DISTINCT l_orderkey AS album_id FROM lineitem WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')"""
NEW_ARTISTS = """SELECT DISTINCT l_suppkey AS artist_id FROM lineitem WHERE NOT EXISTS
    (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_nationkey >= 12)"""


def _missing(name: str, key: str, known: str) -> str:
    return f"""SELECT '{name}' AS dimension, CAST({key} AS VARCHAR) AS key, count(*) AS plays
        FROM lineitem WHERE NOT EXISTS ({known}) GROUP BY {key}"""


UNRESOLVED = " UNION ALL ".join(
    [
        _missing("song", "l_partkey",
                 "SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_type <> 'PROMO'"),
        _missing("album", "l_orderkey",
                 "SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P'"),
        _missing("artist", "l_suppkey",
                 "SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_nationkey >= 12"),
    ]
)

MALFORMED = """SELECT song_id, title, duration_ms, explicit, popularity, count(*) AS n FROM (
    SELECT CASE WHEN event_type IN ('signup', 'click', 'purchase')
            THEN CAST(event_id AS VARCHAR) END AS song_id,
        CASE event_type WHEN 'error' THEN CAST(user_id AS VARCHAR) WHEN 'purchase' THEN '["t"]' END
            AS title,
        CAST(NULL AS VARCHAR) AS duration_ms, CAST(NULL AS VARCHAR) AS explicit,
        CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS popularity
    FROM events) q GROUP BY ALL"""

REJECTED = """SELECT 'song_topic' AS topic, CASE event_type
        WHEN 'view' THEN '{"song_id":"' || event_id || '","title":"cut off'
        ELSE '{"title":' || user_id || ',"popularity":' || CAST(value AS DECIMAL(18, 2)) || '}'
    END AS json_value FROM events WHERE event_type IN ('view', 'error')"""


def _counts(copies: int, broken: bool) -> str:
    """Row counts of the warehouse tables after ``copies`` appends, and of the rejects."""
    good = "event_type IN ('signup', 'click', 'purchase')"
    # Broken song records with a key become songs unless the key is known already.
    extra = f"""UNION ALL SELECT CAST(event_id AS VARCHAR), NULL FROM events WHERE {good}
        AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = event_id)""" if broken else ""
    return f"""
        SELECT 'dim_song' AS table_name, count(*) * {copies} AS n_rows,
            count(DISTINCT song_id) AS n_keys,
            CAST(sum(duration_ms) * {copies} AS BIGINT) AS total
        FROM (SELECT song_id, duration_ms FROM ({SONG_ROWS}) s {extra}) songs
        UNION ALL SELECT 'dim_album', count(*) * {copies}, count(DISTINCT album_id),
            CAST(sum(total_tracks) * {copies} AS BIGINT) FROM ({_album_rows(RELEASE_TEXT)}) a
        UNION ALL SELECT 'dim_artist', count(*) * {copies}, count(DISTINCT artist_id),
            CAST(sum(follower_count) * {copies} AS BIGINT) FROM ({ARTIST_ROWS}) r
        UNION ALL SELECT 'fact_history', count(*) * {copies}, count(DISTINCT song_id),
            CAST(sum(day(CAST(left(played_at, 10) AS DATE))) * {copies} AS BIGINT)
            FROM ({PLAYS}) p
        UNION ALL SELECT 'rejects', count(*), count(DISTINCT topic),
            CAST(sum(length(json_value)) AS BIGINT) FROM ({REJECTED}) x"""


def _topic_count(topic: str, key: str, rows: str) -> str:
    return f"""SELECT '{topic}' AS topic, count(*) AS n_messages, count(DISTINCT {key}) AS n_keys,
        CAST(sum(CAST({key} AS BIGINT)) AS BIGINT) AS key_sum FROM ({rows}) q"""


ROUTED = " UNION ALL ".join(
    [
        _topic_count("song_topic", "song_id", f"""SELECT DISTINCT song_id FROM ({PLAYS}) p
            JOIN part ON p_partkey = CAST(song_id AS BIGINT) WHERE p_type = 'PROMO'"""),
        _topic_count("album_topic", "album_id", f"""SELECT DISTINCT album_id FROM ({PLAYS}) p
            JOIN orders ON o_orderkey = CAST(album_id AS BIGINT) WHERE o_orderstatus = 'P'"""),
        _topic_count("artist_topic", "artist_id", f"""SELECT DISTINCT artist_id FROM ({PLAYS}) p
            JOIN supplier ON s_suppkey = CAST(artist_id AS BIGINT) WHERE s_nationkey < 12"""),
        _topic_count("item_topic", "song_id", PLAYS),
    ]
)


def _after(ms: int) -> str:
    return f"SELECT * FROM ({PLAYS}) p WHERE played_at > strftime(make_timestamp({ms} * 1000), " \
           "'%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


SUMMARY = " UNION ALL ".join(
    f"""SELECT count(*) AS n_plays, count(*) = 0 AS no_new_data, CAST({ms} AS BIGINT) AS after_ms
        FROM ({_after(ms)}) q""" for ms in (0, CURSOR_MS, LATE_CURSOR_MS)
)


# --- report -------------------------------------------------------------------------------------


def _safe(value: str) -> str:
    text = f"coalesce(CAST({value} AS VARCHAR), '')"
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                        ("''", "&#39;")):
        text = f"replace({text}, '{raw}', '{entity}')"
    return text


def _play(title: str, *lines: str, cover: bool = True) -> str:
    style = f" style=''background-image: url(' || {_safe('album_art')} || ');''" if cover else ""
    body = "".join(f" || '<p>' || {line} || '</p>'" for line in lines)
    return f"'<div class=''play''{style}><b>' || {_safe(title)} || '</b>'{body} || '</div>'"


def _cards(as_of: str) -> str:
    by = f"'by ' || {_safe('artist')}"
    listened = f"{_safe('total_minute_listened')} || 'm listened'"
    ago = f"'was played ' || {_safe('days_ago')} || ' days ago'"
    return f"""SELECT as_of, section_no, rank, CASE section_no
        WHEN 1 THEN {_play('song_name', by, listened)}
        WHEN 2 THEN {_play('album', by, listened)}
        WHEN 3 THEN {_play('artist', listened, cover=False)}
        ELSE {_play('song_name', ago)} END AS card
        FROM ({_suite(EVENTS_FACT, as_of)}) suite"""


SECTION_LIST = """(VALUES (1, 'Top 10 Songs'), (2, 'Top 5 Albums'), (3, 'Top 5 Artists'),
    (4, 'Songs you haven''t listened to in a while')) AS sections(section_no, section)"""
DATE_LIST = "(VALUES " + ", ".join(f"('{d}')" for d in REPORT_DATES) + ") AS dates(as_of)"

REPORT_SECTIONS = f"""WITH cards AS ({" UNION ALL ".join(_cards(d) for d in REPORT_DATES)})
    SELECT as_of, section_no, section, '<h3>' || section || '</h3>' || coalesce(
        '<div class=''plays''>' || (SELECT string_agg(card, '' ORDER BY rank) FROM cards c
            WHERE c.as_of = dates.as_of AND c.section_no = sections.section_no) || '</div>',
        '<p>No data available</p>') AS html
    FROM {DATE_LIST}, {SECTION_LIST}"""

REPORT_BODY = f"""SELECT as_of, string_agg(html, '' ORDER BY section_no) AS body
    FROM ({REPORT_SECTIONS}) s GROUP BY as_of"""

REPLY_FIELDS = """SELECT conv_id, turn,
    CASE WHEN turn % 2 = 0 THEN text END AS opening_statement,
    CASE WHEN turn % 2 = 0 THEN 'week ' || turn END AS weekly_recap,
    CASE WHEN turn % 2 = 0 THEN role WHEN role = 'assistant' THEN text END AS mood_recap,
    CASE WHEN turn % 2 = 0 THEN text || ' & more' END AS recommendations,
    CASE WHEN turn % 2 = 0 THEN 'bye' END AS closing_statement,
    turn % 2 = 0 AS is_valid FROM conversations"""

REPORT_FINAL = f"""WITH turns AS (SELECT CASE role WHEN 'system' THEN '{EVENTS_WEEK}'
            WHEN 'user' THEN '{EVENTS_END}' ELSE '{EMPTY_WEEK}' END AS as_of, role,
        count(*) AS n, min(text) AS first_text, max(text) AS last_text
        FROM conversations GROUP BY role)
    SELECT b.as_of, coalesce(role <> 'system', false) AS is_valid, concat_ws(chr(10),
        '<html><body>',
        '<p>' || {_safe("'turns: ' || n")} || '</p>',
        '<h2>Recaps</h2>',
        '<p>' || {_safe('first_text')} || '</p>',
        '<p>' || {_safe('role')} || '</p>',
        body,
        '<h2>Recommendations</h2>',
        '<p>' || {_safe('last_text')} || '</p>',
        '<p>' || {_safe("CASE WHEN role <> 'system' THEN '''bye'' & <thanks>' END")} || '</p>',
        '</body></html>') AS html
    FROM ({REPORT_BODY}) b LEFT JOIN turns t ON b.as_of = t.as_of"""

BOUNDS = f"""SELECT DISTINCT CAST(CAST(played_at AS DATE) AS VARCHAR) AS day,
        date_trunc('week', played_at) - INTERVAL '1' DAY + INTERVAL '1' MINUTE AS week_start,
        date_trunc('week', played_at) + INTERVAL '5' DAY + INTERVAL '8' HOUR
            + INTERVAL '59' MINUTE AS week_end
    FROM (SELECT l_shipdate AS played_at FROM lineitem UNION ALL SELECT ts FROM events) p"""

def _interval(text: str) -> str:
    number, unit = text.split()
    return f"INTERVAL '{number}' {unit.rstrip('s').upper()}"


_PLAYED = f"""(SELECT CAST({SONG_ID} AS VARCHAR) AS song_id, CAST(user_id AS VARCHAR) AS album_id,
    CAST({SONG_ID} % 10 AS VARCHAR) AS artist_id, date_trunc('milliseconds', ts) AS played_at FROM events)"""
# A batch rejects what lies too far behind the newest play of the batches before it, which hold all plays until the cut.
REDELIVERED = f"""SELECT * FROM (SELECT DISTINCT false AS rejected, *, CAST(1 AS BIGINT) AS n FROM {_PLAYED} p UNION ALL
    SELECT true, song_id, album_id, artist_id, NULL, count(*) FROM ({" UNION ALL ".join(
        f"SELECT p.* FROM {_PLAYED} p WHERE played_at < TIMESTAMP '{end}' AND played_at < (SELECT max(played_at) FROM {_PLAYED} q "
        f"WHERE played_at < TIMESTAMP '{cut}') - {_interval(DELAY)}" for cut, end in zip(CUTS, (*CUTS[1:], "2100-01-01")))}) late
    GROUP BY song_id, album_id, artist_id)"""
LATE_DETAILS = f"""SELECT f.*, arrived_at FROM {EVENTS_FACT} f LEFT JOIN (
    SELECT p_partkey AS song_id, TIMESTAMP '2024-01-01' + to_hours(p_size * 16) AS arrived_at FROM part) a ON f.song_id = a.song_id
    AND arrived_at BETWEEN played_at - {_interval(BEFORE)} AND played_at + {_interval(WAIT)}"""
MENDED = """SELECT kind, value, title, count(*) AS n FROM (
    SELECT 'song' AS kind, CAST(event_id AS VARCHAR) AS value,
        CASE event_type WHEN 'purchase' THEN '["t"]' WHEN 'view' THEN 'cut off' END AS title FROM events WHERE event_type <> 'error'
    UNION ALL SELECT DISTINCT 'song', 'user ' || user_id, 'mended' FROM events
        WHERE event_type = 'error' AND length(CAST(user_id AS VARCHAR)) > 1
    UNION ALL SELECT 'rejected', '{"title":' || user_id || ',"popularity":' || CAST(value AS DECIMAL(18, 2)) || '}', NULL FROM events
        WHERE event_type = 'error' AND length(CAST(user_id AS VARCHAR)) = 1) r GROUP BY ALL"""
BATCH_METRICS = f"""SELECT CAST(batch AS BIGINT) AS batch_id, topic, count(*) AS n_records, count(*) FILTER (WHERE bad) AS n_rejects FROM (
    SELECT 0 AS batch, 'song_topic' AS topic, false AS bad FROM part UNION ALL SELECT 1, 'song_topic', false FROM part
    UNION ALL SELECT 0, 'album_topic', false FROM orders UNION ALL SELECT 0, 'artist_topic', false FROM supplier
    UNION ALL SELECT 0, 'item_topic', false FROM {PAGE_PLAYS} p
    UNION ALL SELECT 1, 'song_topic', event_type IN ('view', 'error') FROM events) r GROUP BY batch, topic"""

ORACLE: dict[str, str] = {
    "recap_top_songs": _songs(LINEITEM_FACT, LINEITEM_WEEK),
    "recap_top_albums": _albums(LINEITEM_FACT, LINEITEM_WEEK),
    "recap_top_artists": _artists(LINEITEM_FACT, LINEITEM_WEEK),
    "recap_forgotten_songs": _forgotten(LINEITEM_FACT, LINEITEM_END),
    "recap_forgotten_songs_past": _forgotten(LINEITEM_FACT, LINEITEM_PAST),
    "recap_forgotten_songs_days": " UNION ALL ".join(
        f"""SELECT '{day}' AS as_of, CAST(row_number() OVER (ORDER BY days_ago DESC NULLS LAST, song_name NULLS FIRST,
            album_art NULLS FIRST) AS INTEGER) AS rank, song_name, album_art, last_played, CAST(days_ago AS VARCHAR) AS days_ago
            FROM ({_forgotten(LINEITEM_FACT, day)}) f""" for day in LINEITEM_DAYS),
    "recap_top_songs_events": _songs(EVENTS_FACT, EVENTS_WEEK),
    "recap_top_albums_events": _albums(EVENTS_FACT, EVENTS_WEEK),
    "recap_top_artists_events": _artists(EVENTS_FACT, EVENTS_WEEK),
    "recap_forgotten_songs_events": _forgotten(EVENTS_FACT, EVENTS_END),
    "recap_suite": _suite_text(EVENTS_FACT, EVENTS_END),
    "recap_suite_dates": " UNION ALL ".join(_suite_text(EVENTS_FACT, d) for d in REPORT_DATES),
    "recap_suite_from_counts": " UNION ALL ".join(_suite_text(EVENTS_FACT, d) for d in REPORT_DATES),
    "join_fact_song": """SELECT l_partkey AS song_id, p_name AS song_name, count(*) AS plays,
        CAST(sum(p_size * 10000) AS BIGINT) AS ms
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "join_fact_album": """SELECT l_orderkey AS album_id, o_orderpriority AS album,
        o_orderstatus AS album_art, count(*) AS plays
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "join_fact_artist": """SELECT l_suppkey AS artist_id, s_name AS artist, count(*) AS plays
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
    "week_bounds_by_day": BOUNDS,
    "week_filter": f"SELECT * FROM {EVENTS_FACT} f WHERE {_in_week(EVENTS_WEEK)}",
    "minutes_by_song": f"""SELECT song_name, {MINUTES} AS total_minute_listened
        FROM {LINEITEM_FACT} f {JOIN_SONG} GROUP BY ALL""",
    "last_played_days": f"""SELECT song_name, max(played_at) AS last_played,
        CAST(datediff('day', CAST(max(played_at) AS DATE), DATE '{LINEITEM_END}') AS INTEGER)
            AS days_ago
        FROM {LINEITEM_FACT} f {JOIN_SONG} GROUP BY song_name""",
    "topk_tiebreak": """SELECT l_partkey AS song_id, p_name AS song_name, count(*) AS plays
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
        ORDER BY plays DESC, song_id, song_name LIMIT 25""",
    "unresolved_facts": UNRESOLVED,
    "parse_song_topic": SONG_ROWS,
    "parse_album_topic": _album_rows(RELEASE_DAY),
    "parse_artist_topic": ARTIST_ROWS,
    "parse_item_topic": """SELECT CAST(l_partkey AS VARCHAR) AS song_id,
        CAST(l_orderkey AS VARCHAR) AS album_id, CAST(l_suppkey AS VARCHAR) AS artist_id,
        l_shipdate AS played_at FROM lineitem""",
    "parse_malformed": MALFORMED,
    "rejected_records": REJECTED,
    "stream_dispatch": _counts(1, broken=True),
    "warehouse_roundtrip": _counts(2, broken=False),
    "redelivered_plays": REDELIVERED,
    "late_details": LATE_DETAILS,
    "batch_metrics": BATCH_METRICS,
    "mended_rejects": MENDED,
    "compaction_roundtrip": _counts(6, broken=False),
    "pipeline_roundtrip": _suite_text(PAYLOAD_FACT, EVENTS_END, PAYLOAD_ALBUM),
    "explode_plays": PLAYS,
    "history_source": PLAYS,
    "event_id_shape": f"""SELECT count(*) AS n_plays, count(*) AS n_ids, count(*) AS n_hex
        FROM {PAGE_PLAYS} p""",
    "flatten_song": SONG_ROWS,
    "flatten_album": _album_rows(RELEASE_TEXT),
    "flatten_artist": ARTIST_ROWS,
    "preview_default": """SELECT CASE p_size % 3 WHEN 0 THEN 'No preview available'
            WHEN 1 THEN 'null' ELSE 'url' END AS preview,
        count(*) AS n, min(p_size) AS least, max(p_size) AS most FROM part GROUP BY 1""",
    "route_topics": ROUTED,
    "new_keys_song": NEW_SONGS,
    "new_keys_album": NEW_ALBUMS,
    "new_keys_artist": NEW_ARTISTS,
    "enrich_new_keys": f"""SELECT album_id, title, total_tracks, release_date, popularity
        FROM ({_album_rows(RELEASE_TEXT)}) a
        WHERE CAST(album_id AS BIGINT) IN ({NEW_ALBUMS})""",
    "batch_summary": SUMMARY,
    "plays_after_cursor": _after(CURSOR_MS),
    "report_cards": _cards(EVENTS_END),
    "report_sections": REPORT_SECTIONS,
    "report_body": REPORT_BODY,
    "reply_fields": REPLY_FIELDS,
    "report_final": REPORT_FINAL,
}
