"""The registered queries in plain SQL for another engine, written straight from the test tables."""

from __future__ import annotations

from postloom.catalog.queries import (
    AUDIT_BATCHES,
    CRAWL_DAY,
    CRAWL_DAYS_BACK,
    CRAWL_KEYWORDS,
    DEEP_PAGE,
    DEEP_SIZE,
    KEYED_BATCHES,
    NEWEST,
    NEWEST_MANY,
    ONE_CUSTOMER,
    PAGE_SIZE,
    PAGE_START,
    TOPIC_FIELDS,
    WORKLIST_THRESHOLD,
)
from postloom.operators.letters import LETTERS
from postloom.plans.gold import MIN_HASHTAG_USES, TOP_USERS
from postloom.sources.samples import LEXICON, STOP_WORDS, WORDLESS


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


# Message fields of every event, before faults of the JSON text.
FIELDS = f"""
numbered AS (
  SELECT *, event_id % (SELECT count(*) FROM documents) AS doc_id FROM events
), fields AS (
  SELECT e.event_id, e.ts,
    CASE WHEN e.event_id % 97 = 1 THEN 'retweet' WHEN e.event_id % 4 = 0 THEN 'tweet' ELSE 'reply' END AS type,
    CASE WHEN e.event_id % 89 <> 5 THEN CAST(e.event_id AS VARCHAR) END AS id,
    'https://ex.org/' || CAST(e.event_id AS VARCHAR) AS url,
    CASE WHEN e.event_id % 107 <> 0 THEN e.event_type END AS keyword,
    CASE WHEN e.event_id % 101 = 0 THEN '' WHEN e.event_id % 29 = 0 THEN '{WORDLESS}'
      ELSE d.text || ' #' || e.event_type || ' #tag_' || CAST(e.user_id % 9 AS VARCHAR)
        || ' @user' || CAST(e.user_id % 7 AS VARCHAR)
        || CASE WHEN e.event_id % 5 = 0 THEN ' https://ex.org/p1' ELSE '' END END AS text,
    CASE WHEN e.event_id % 31 <> 7 THEN date_trunc('second', e.ts) END AS created_at,
    CASE WHEN e.event_id % 31 = 7 THEN 'not a date'
      WHEN e.event_id % 3 = 0 THEN strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ')
      WHEN e.event_id % 3 = 1 THEN strftime(e.ts, '%Y-%m-%d %H:%M:%S')
      ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS created_text,
    d.lang AS language,
    CASE WHEN e.event_id % 103 <> 0 THEN 'user' || CAST(e.user_id AS VARCHAR) END AS username,
    CAST(e.user_id AS VARCHAR) AS user_id,
    'User ' || CAST(e.user_id AS VARCHAR) AS user_name,
    e.event_id % 4 <> 0 AS is_reply,
    CASE WHEN e.event_id % 4 <> 0 THEN CAST(e.event_id - 1 AS VARCHAR) END AS in_reply_to_id,
    CAST(NULL AS VARCHAR) AS in_reply_to_username,
    CASE WHEN e.event_id % 4 <> 0 AND e.event_id % 109 <> 0
      THEN CAST(e.event_id - e.event_id % 4 AS VARCHAR) END AS root_tweet_id,
    CAST(e.event_id % 5 AS INTEGER) AS reply_count,
    CAST(e.event_id % 17 AS INTEGER) AS retweet_count,
    CASE WHEN e.event_id % 13 <> 0 THEN CAST(floor(e.value) AS INTEGER) END AS like_count,
    CAST(e.event_id % 3 AS INTEGER) AS quote_count,
    CAST(e.event_id % 1000 AS INTEGER) AS view_count,
    CAST(e.event_id % 7 AS INTEGER) AS bookmark_count
  FROM numbered e JOIN documents d ON d.doc_id = e.doc_id
)"""

SILVER = f"""{FIELDS}, silver AS (
  SELECT coalesce(keyword, 'default') AS kafka_key, ts AS kafka_timestamp, 0 AS kafka_partition,
    event_id AS kafka_offset, type, id AS tweet_id, url AS tweet_url, keyword, text, language, created_at,
    username, user_id, user_name, is_reply, in_reply_to_id, in_reply_to_username, root_tweet_id,
    reply_count, retweet_count, like_count, quote_count, view_count, bookmark_count,
    strftime(created_at, '%Y-%m-%d') AS created_date,
    CAST(hour(created_at) AS INTEGER) AS created_hour,
    CAST(dayofweek(created_at) + 1 AS INTEGER) AS created_day_of_week,
    CAST(length(text) AS INTEGER) AS text_length,
    CAST(len(string_split_regex(text, '\\s+')) AS INTEGER) AS word_count,
    regexp_matches(text, 'https?://') AS has_url,
    regexp_matches(text, '#\\w+') AS has_hashtag,
    regexp_matches(text, '@\\w+') AS has_mention,
    CAST(coalesce(like_count, 0) + coalesce(retweet_count, 0) + coalesce(reply_count, 0)
      + coalesce(quote_count, 0) AS BIGINT) AS total_engagement,
    regexp_extract_all(text, '#(\\w+)', 1) AS tags,
    array_to_string(regexp_extract_all(text, '#(\\w+)', 1), ' ') AS hashtags,
    array_to_string(regexp_extract_all(text, '@(\\w+)', 1), ' ') AS mentions,
    CAST(len(regexp_extract_all(text, '#(\\w+)', 1)) AS INTEGER) AS hashtag_count,
    CAST(len(regexp_extract_all(text, '@(\\w+)', 1)) AS INTEGER) AS mention_count
  FROM fields
  WHERE event_id % 211 <> 0 AND id IS NOT NULL AND length(text) > 0 AND username IS NOT NULL
    AND type IN ('tweet', 'reply')
)"""

# The cleaning steps one by one, from the innermost outwards.
_ESCAPES = r"replace(replace(replace(replace(lower(coalesce(text, '')), '\t', ' '), '\n', ' '), '\u', ''), '\', '')"
_ASCII = rf"regexp_replace({_ESCAPES}, '[^\x00-\x7F]', '?', 'g')"
_MARKS = rf"regexp_replace({_ASCII}, '[@#][A-Za-z0-9]+|\w+://[^\s\x0b\x1c-\x1f]+', ' ', 'g')"
_BLANKS = rf"trim(regexp_replace({_MARKS}, '[\s\x0b\x1c-\x1f]+', ' ', 'g'))"
_CUT_LINKS = f"replace(replace({_BLANKS}, 'http://', ' '), 'https://', ' ')"
_DIGITS = rf"regexp_replace({_CUT_LINKS}, '[0-9]+', '', 'g')"
_PUNCTUATION = rf"regexp_replace({_DIGITS}, '[!-/:-@\[-`{{-~]', '', 'g')"
_SINGLE_BLANKS = rf"regexp_replace(trim({_PUNCTUATION}), '[\s\x0b\x1c-\x1f]+', ' ', 'g')"
CLEANED = rf"regexp_replace({_SINGLE_BLANKS}, '\b[a-zA-Z]\b', '', 'g')"
KEPT_WORDS = (
    f"array_to_string(list_filter(string_split(cleaned_text, ' '), lambda w: w NOT IN ({_list(STOP_WORDS)})), ' ')"
)

NLP = f"""{SILVER}, cleaned AS (
  SELECT *, {CLEANED} AS cleaned_text FROM silver
), nlp AS (
  SELECT tweet_id, keyword, type, username, created_at, created_date, text AS original_text, cleaned_text,
    {KEPT_WORDS} AS stopword_text, total_engagement, like_count, retweet_count, reply_count, language
  FROM cleaned
)"""

_WEIGHTS = " ".join(f"WHEN '{word}' THEN {weight}" for word, weight in LEXICON.items())


def _predictions(unscored: str) -> str:
    return f"""{NLP}, weighed AS (
  SELECT *, list_sum(list_transform(string_split(stopword_text, ' '),
    lambda w: CASE w {_WEIGHTS} ELSE 0 END)) AS weight
  FROM nlp
), predictions AS (
  SELECT tweet_id, keyword, username, created_at, created_date, original_text, cleaned_text, stopword_text,
    CASE WHEN {unscored} THEN NULL WHEN weight > 0 THEN 'positive' WHEN weight < 0 THEN 'negative'
      ELSE 'neutral' END AS sentiment,
    total_engagement, like_count
  FROM weighed
)"""


PREDICTIONS = _predictions("stopword_text = ''")
BATCH_PREDICTIONS = _predictions("trim(stopword_text) = ''")


def _trend(condition: str) -> str:
    return f"""WITH {PREDICTIONS}
SELECT created_date, keyword, sentiment, count(*) AS post_count, avg(total_engagement) AS avg_engagement,
  CAST(sum(like_count) AS BIGINT) AS total_likes,
  CAST(CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END AS INTEGER) AS sentiment_score
FROM predictions WHERE {condition} GROUP BY created_date, keyword, sentiment"""


def _threads(tweets: str) -> str:
    return f"""SELECT t.*,
  coalesce(r.n, 0) AS actual_reply_count,
  coalesce(r.repliers, 0) AS unique_repliers,
  coalesce(r.engagement, 0) AS replies_engagement,
  t.original_engagement + coalesce(r.engagement, 0) AS conversation_total_engagement
FROM ({tweets}) t LEFT JOIN (
  SELECT root_tweet_id, count(*) AS n, count(DISTINCT username) AS repliers,
    CAST(sum(total_engagement) AS BIGINT) AS engagement
  FROM silver WHERE type = 'reply' GROUP BY root_tweet_id
) r ON t.tweet_id = r.root_tweet_id"""


THREADS = f"WITH {SILVER} " + _threads(
    """SELECT keyword, tweet_id, username AS original_poster, text AS original_tweet_text, created_at, created_date,
    like_count AS original_likes, retweet_count AS original_retweets, reply_count AS original_reply_count,
    total_engagement AS original_engagement FROM silver WHERE type = 'tweet'"""
)

TURNS = (
    """WITH silver AS (
  SELECT CASE WHEN turn = 0 THEN 'tweet' ELSE 'reply' END AS type,
    CAST(conv_id AS VARCHAR) || CASE WHEN turn = 0 THEN '' ELSE '-' || CAST(turn AS VARCHAR) END AS tweet_id,
    CASE WHEN turn <> 0 THEN CAST(conv_id AS VARCHAR) END AS root_tweet_id,
    role AS keyword, role AS username, text, CAST(length(text) AS INTEGER) AS like_count, 0 AS retweet_count,
    0 AS reply_count, CAST(length(text) AS BIGINT) AS total_engagement
  FROM conversations
) """
    + _threads(
        """SELECT keyword, tweet_id, username AS original_poster, text AS original_tweet_text,
    like_count AS original_likes, retweet_count AS original_retweets, reply_count AS original_reply_count,
    total_engagement AS original_engagement FROM silver WHERE type = 'tweet'"""
    )
)

SILVER_ROWS = f"WITH {SILVER} SELECT * EXCLUDE (tags) FROM silver"

TWEET_STATS = f"""WITH {SILVER}
SELECT created_date, keyword, count(*) AS total_tweets,
  count(DISTINCT username) AS unique_users, count(DISTINCT tweet_id) AS unique_tweet_ids,
  CAST(sum(like_count) AS BIGINT) AS total_likes, CAST(sum(retweet_count) AS BIGINT) AS total_retweets,
  CAST(sum(reply_count) AS BIGINT) AS total_replies, CAST(sum(quote_count) AS BIGINT) AS total_quotes,
  CAST(sum(view_count) AS BIGINT) AS total_views, CAST(sum(bookmark_count) AS BIGINT) AS total_bookmarks,
  CAST(sum(total_engagement) AS BIGINT) AS total_engagement,
  avg(like_count) AS avg_likes, avg(retweet_count) AS avg_retweets, avg(reply_count) AS avg_replies,
  avg(total_engagement) AS avg_engagement, avg(text_length) AS avg_text_length,
  avg(word_count) AS avg_word_count, avg(hashtag_count) AS avg_hashtags, avg(mention_count) AS avg_mentions,
  count(*) FILTER (WHERE has_url) AS tweets_with_url,
  count(*) FILTER (WHERE has_hashtag) AS tweets_with_hashtag,
  count(*) FILTER (WHERE has_mention) AS tweets_with_mention,
  count(*) FILTER (WHERE is_reply) AS reply_tweets,
  count(*) FILTER (WHERE language = 'en') AS english_tweets,
  count(*) FILTER (WHERE language = 'id') AS indonesian_tweets,
  min(created_at) AS first_tweet_time, max(created_at) AS last_tweet_time
FROM silver WHERE type = 'tweet' GROUP BY created_date, keyword"""

REPLY_STATS = f"""WITH {SILVER}
SELECT created_date, keyword, count(*) AS total_replies, count(DISTINCT username) AS unique_repliers,
  count(DISTINCT root_tweet_id) AS unique_root_tweets, CAST(sum(like_count) AS BIGINT) AS total_reply_likes,
  CAST(sum(retweet_count) AS BIGINT) AS total_reply_retweets, avg(total_engagement) AS avg_reply_engagement,
  avg(text_length) AS avg_reply_length, avg(word_count) AS avg_reply_words
FROM silver WHERE type = 'reply' GROUP BY created_date, keyword"""

TOP = f"""WITH {SILVER}, users AS (
  SELECT keyword, username, user_name, user_id, count(*) AS post_count,
    count(*) FILTER (WHERE type = 'tweet') AS tweet_count,
    count(*) FILTER (WHERE type = 'reply') AS reply_count,
    CAST(sum(silver.like_count) AS BIGINT) AS total_likes,
    CAST(sum(silver.retweet_count) AS BIGINT) AS total_retweets,
    CAST(sum(silver.reply_count) AS BIGINT) AS total_replies_received,
    CAST(sum(silver.total_engagement) AS BIGINT) AS total_engagement,
    avg(silver.total_engagement) AS avg_engagement_per_post, max(created_at) AS last_post_time
  FROM silver GROUP BY keyword, username, user_name, user_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY keyword
    ORDER BY total_engagement DESC, username, user_id, user_name) AS INTEGER) AS user_rank
  FROM users
)
SELECT * FROM ranked WHERE user_rank <= {TOP_USERS}"""

HASHTAGS = f"""WITH {SILVER}, used AS (
  SELECT created_date, keyword, type, unnest(tags) AS hashtag FROM silver
)
SELECT created_date, keyword, hashtag, count(*) AS hashtag_usage_count,
  count(*) FILTER (WHERE type = 'tweet') AS in_tweets, count(*) FILTER (WHERE type = 'reply') AS in_replies
FROM used GROUP BY created_date, keyword, hashtag HAVING count(*) >= {MIN_HASHTAG_USES}"""

HOURLY = f"""WITH {SILVER}
SELECT keyword, created_hour, created_day_of_week, count(*) AS total_posts,
  count(*) FILTER (WHERE type = 'tweet') AS tweet_count, count(*) FILTER (WHERE type = 'reply') AS reply_count,
  avg(total_engagement) AS avg_engagement
FROM silver GROUP BY keyword, created_hour, created_day_of_week"""

VIOLATIONS = f"""WITH {FIELDS}, parsed AS (
  SELECT event_id % 211 = 0 AS broken, * FROM fields
)
SELECT rule, action, violations, rows FROM (
  SELECT 'valid_id' AS rule, 'drop' AS action, count(*) FILTER (WHERE broken OR id IS NULL) AS violations,
    count(*) AS rows FROM parsed
  UNION ALL
  SELECT 'valid_text', 'drop', count(*) FILTER (WHERE broken OR text = ''), count(*) FROM parsed
  UNION ALL
  SELECT 'valid_username', 'drop', count(*) FILTER (WHERE broken OR username IS NULL), count(*) FROM parsed
  UNION ALL
  SELECT 'valid_type', 'drop', count(*) FILTER (WHERE broken OR type = 'retweet'), count(*) FROM parsed
  UNION ALL
  SELECT 'valid_date', 'warn', count(*) FILTER (WHERE broken OR created_at IS NULL), count(*) FROM parsed
) v"""

AUDIT = f"""WITH {FIELDS}, judged AS (
  SELECT event_id % 211 = 0 AS broken, * FROM fields
)
SELECT event_id % {AUDIT_BATCHES} AS batch, count(*) AS rows_in,
  count(*) FILTER (WHERE NOT broken AND id IS NOT NULL AND text <> '' AND username IS NOT NULL AND type <> 'retweet') AS rows_out,
  count(*) FILTER (WHERE broken OR id IS NULL) AS valid_id,
  count(*) FILTER (WHERE broken OR text = '') AS valid_text,
  count(*) FILTER (WHERE broken OR username IS NULL) AS valid_username,
  count(*) FILTER (WHERE broken OR type = 'retweet') AS valid_type,
  count(*) FILTER (WHERE broken OR created_at IS NULL) AS valid_date
FROM judged GROUP BY 1"""

DEDUPE = f"""WITH {SILVER}, crawled AS (
  SELECT keyword, tweet_id, type, text, like_count, kafka_timestamp, kafka_offset FROM silver
  UNION ALL
  SELECT keyword, tweet_id, type, text, CAST(like_count + 1 AS INTEGER), kafka_timestamp + INTERVAL 40 DAY,
    kafka_offset FROM silver
)
SELECT * FROM crawled
QUALIFY row_number() OVER (PARTITION BY keyword, tweet_id ORDER BY kafka_timestamp DESC, kafka_offset DESC) = 1"""

WORKLIST = f"""WITH {SILVER}
SELECT keyword, tweet_id, reply_count FROM silver t
WHERE type = 'tweet' AND coalesce(reply_count, 0) >= {WORKLIST_THRESHOLD}
  AND NOT EXISTS (SELECT 1 FROM silver r WHERE r.type = 'reply' AND r.root_tweet_id = t.tweet_id
    AND r.keyword IS NOT DISTINCT FROM t.keyword)"""

ORPHANS = f"""WITH {SILVER}
SELECT keyword, tweet_id, root_tweet_id, username FROM silver r
WHERE type = 'reply'
  AND NOT EXISTS (SELECT 1 FROM silver t WHERE t.type = 'tweet' AND t.tweet_id = r.root_tweet_id)"""

RECENT = f"""WITH {SILVER}
SELECT keyword, tweet_id, type, text, created_at, created_date FROM silver
WHERE created_at >= DATE '{CRAWL_DAY}' - INTERVAL {CRAWL_DAYS_BACK} DAY AND created_at < DATE '{CRAWL_DAY}'
  AND keyword IN ({_list(CRAWL_KEYWORDS)})"""

NEWEST_POSTS = f"""WITH {SILVER}
SELECT keyword, tweet_id, type, created_at, text FROM silver
QUALIFY row_number() OVER (PARTITION BY keyword
  ORDER BY created_at DESC NULLS LAST, tweet_id, kafka_offset DESC) <= {NEWEST}"""


NEWEST_MANY_POSTS = f"""WITH {SILVER}
SELECT keyword, tweet_id, type, created_at, kafka_offset FROM silver
QUALIFY row_number() OVER (PARTITION BY keyword
  ORDER BY created_at DESC NULLS LAST, tweet_id, kafka_offset DESC) <= {NEWEST_MANY}"""

STORED_TOP = TOP.replace(
    "FROM silver", "FROM (SELECT * REPLACE (CASE kafka_offset % 7 WHEN 1 THEN '' WHEN 2 THEN '01' WHEN 3 THEN '1' ELSE keyword END AS keyword) FROM silver) AS silver"
)


def _counter(name: str) -> str:
    return f"CASE WHEN event_id % 11 = 0 THEN 0 ELSE {name} END AS {name}"


API = f"""WITH {FIELDS}, objects AS (
  SELECT *, event_id % 103 = 0 AS no_author FROM fields
)
SELECT CASE WHEN root_tweet_id IS NULL THEN 'tweet' ELSE 'reply' END AS type, id, url, keyword, text,
  created_text AS created_at, language AS lang,
  username,
  CASE WHEN NOT no_author THEN user_id END AS user_id, CASE WHEN NOT no_author THEN user_name END AS user_name,
  CASE WHEN event_id % 11 = 0 THEN root_tweet_id IS NOT NULL ELSE is_reply END AS is_reply,
  in_reply_to_id, in_reply_to_username, root_tweet_id,
  {_counter("reply_count")}, {_counter("retweet_count")}, {_counter("like_count")},
  {_counter("quote_count")}, {_counter("view_count")}, {_counter("bookmark_count")}
FROM objects"""

def _as_text(field: str) -> str:
    return "strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')" if field == "created_at" else field


TOPIC = f"""WITH {SILVER}
SELECT coalesce(keyword, 'default') AS key,
  CAST(to_json(struct_pack({", ".join(f"{f} := {_as_text(f)}" for f in TOPIC_FIELDS)})) AS VARCHAR) AS value
FROM silver"""

ROUTING = f"""WITH {SILVER}
SELECT coalesce('social_posts-' || strftime(created_at, '%Y.%m.%d'), 'social_posts-current') AS _index,
  tweet_id, keyword, text, kafka_offset, created_date
FROM silver"""

DOCUMENTS = f"SELECT doc_id, {CLEANED} AS cleaned_text FROM documents"

CUSTOMERS = "customers AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer)"
PRODUCTS = "products AS (SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part)"
# Parts without a key are left out by whatever writes them.
SPREAD = """spread AS (
  SELECT p_partkey * 2 AS id, p_name AS name, p_retailprice AS balance FROM part WHERE p_partkey % 50 <> 7
)"""
CHANGES = """changes AS (
  SELECT o_custkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS name,
    CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS balance, o_orderkey AS seq,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'create' WHEN '2' THEN 'index' WHEN '5' THEN 'delete'
      ELSE 'update' END AS op
  FROM orders
)"""

FAULTY = f"""{CHANGES}, faulty AS (
  SELECT CASE WHEN seq % 103 <> 9 THEN id END AS id, name, balance,
    CASE WHEN seq % 97 = 5 THEN NULL WHEN seq % 101 = 7 THEN seq - 1 ELSE seq END AS seq, op
  FROM changes
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY seq) AS times FROM faulty WHERE id IS NOT NULL AND seq IS NOT NULL
), sound AS (
  SELECT id, name, balance, seq, op FROM counted WHERE times = 1
)"""

# One window over all actions of a key: fine for a small check, not for a hot key.
_JUDGED = """log AS (
  SELECT id, name, balance, seq, op FROM sound
  UNION ALL
  SELECT id, name, balance, -1, 'index' FROM customers WHERE id IN (SELECT id FROM sound)
), before AS (
  SELECT *, coalesce(last_value(CASE op WHEN 'create' THEN TRUE WHEN 'index' THEN TRUE WHEN 'delete' THEN FALSE END
    IGNORE NULLS) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS was
  FROM log
), judged AS (
  SELECT *, CASE op WHEN 'index' THEN TRUE WHEN 'create' THEN NOT was ELSE was END AS valid FROM before
)"""

JUDGED = f"{CUSTOMERS}, {FAULTY}, {_JUDGED}"

_FOLDED = """lives AS (
  SELECT *, max(CASE WHEN op <> 'update' THEN seq END) OVER (PARTITION BY id) AS life FROM judged WHERE valid
), folded AS (
  SELECT id, max_by(name, seq) FILTER (WHERE name IS NOT NULL) AS name,
    max_by(balance, seq) FILTER (WHERE balance IS NOT NULL) AS balance,
    bool_or(op = 'delete' AND seq = life) AS gone
  FROM lives WHERE seq >= life GROUP BY id
)
SELECT id, name, balance FROM folded WHERE NOT gone
UNION ALL
SELECT id, name, balance FROM customers WHERE id NOT IN (SELECT id FROM sound)"""

BULK = f"WITH {JUDGED}, {_FOLDED}"


def _bulk_table(name: str, table: str, sound: str, value: str) -> str:
    """A table after the actions on it, with the columns of the common result."""
    other = "price" if value == "balance" else "balance"
    folded = f"WITH {table}, {sound}, {_JUDGED}, {_FOLDED}"
    return f"""SELECT '{name}' AS _index, id, name, balance AS {value}, CAST(NULL AS DOUBLE) AS {other} FROM ({folded})"""


_PRODUCTS_AS_CUSTOMERS = "customers AS (SELECT p_partkey AS id, p_name AS name, p_retailprice AS balance FROM part)"
_ON_PRODUCTS = """sound AS (
  SELECT p_partkey * 2 AS id, p_name AS name, p_retailprice AS balance, p_partkey AS seq,
    CASE p_partkey % 3 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'index' END AS op
  FROM part
)"""
BULK_LOG = f"""SELECT _index, id, name, balance, price FROM (
{_bulk_table("customers", CUSTOMERS, f"{CHANGES}, sound AS (SELECT * FROM changes)", "balance")}
UNION ALL BY NAME
{_bulk_table("products", _PRODUCTS_AS_CUSTOMERS, _ON_PRODUCTS, "price")}
)"""

# Multinomial naive Bayes with add-one smoothing, from sums by label and letter.
MODEL = f"""WITH counts AS (
  SELECT doc_id, letter, length(coalesce(text, '')) - length(replace(coalesce(text, ''), letter, '')) AS n
  FROM documents, (SELECT unnest(string_split('{LETTERS}', '')) AS letter)
), known AS (
  SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL AND doc_id IN (SELECT doc_id FROM documents)
), sums AS (
  SELECT quality, letter, sum(n) + 1 AS n FROM counts JOIN known USING (doc_id) GROUP BY ALL
), weights AS (
  SELECT quality, letter, ln(n) - ln(sum(n) OVER (PARTITION BY quality)) AS weight FROM sums
), priors AS (
  SELECT quality, ln(count(*) + 1) - ln((SELECT count(*) + count(DISTINCT quality) FROM known)) AS prior FROM known GROUP BY 1
), posteriors AS (
  SELECT doc_id, quality, any_value(prior) + sum(n * weight) AS posterior
  FROM counts JOIN weights USING (letter) JOIN priors USING (quality) GROUP BY ALL
), best AS (
  SELECT doc_id, arg_max(quality, posterior) AS quality FROM posteriors GROUP BY 1
)
SELECT d.doc_id, CASE WHEN d.text <> '' THEN CASE quality WHEN 1 THEN 'good' ELSE 'poor' END END AS label
FROM documents d JOIN best b ON d.doc_id = b.doc_id"""

KEYED_STORE = f"""WITH {CHANGES}
SELECT id, name, balance, seq FROM changes
QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq % {KEYED_BATCHES} DESC, seq DESC) = 1"""


def _ordered(sql: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})"


_BY_DATE = "created_date DESC NULLS LAST"
_TREND_ORDER = f"{_BY_DATE}, keyword NULLS FIRST, sentiment NULLS FIRST"

SQL: dict[str, str] = {
    "threads": THREADS,
    "silver": SILVER_ROWS,
    "dq_violations": VIOLATIONS,
    "tweet_stats": TWEET_STATS,
    "reply_stats": REPLY_STATS,
    "top_users": TOP,
    "threads_ranked": THREADS,
    "conversation_turns": TURNS,
    "trending_hashtags": HASHTAGS,
    "hourly_activity": HOURLY,
    "nlp_preprocessed": f"WITH {NLP} SELECT * FROM nlp",
    "clean_documents": DOCUMENTS,
    "stopword_documents": f"WITH cleaned AS ({DOCUMENTS}) SELECT doc_id, {KEPT_WORDS} AS stopword_text FROM cleaned",
    "predictions_lexicon": f"WITH {PREDICTIONS} SELECT * FROM predictions",
    "predictions_row_udf": f"WITH {PREDICTIONS} SELECT * FROM predictions",
    "predictions_batch_udf": f"WITH {BATCH_PREDICTIONS} SELECT * FROM predictions",
    "sentiment_analytics": _trend("TRUE"),
    "sentiment_analytics_nonnull": _trend("sentiment IS NOT NULL"),
    "dedupe_latest": DEDUPE,
    "hot_posts_worklist": WORKLIST,
    "orphan_replies": ORPHANS,
    "recent_window": RECENT,
    "newest_per_keyword": NEWEST_POSTS,
    "newest_many_per_keyword": NEWEST_MANY_POSTS,
    "normalise_api_json": API,
    "topic_rows": TOPIC,
    "index_routing": ROUTING,
    "insert_if_absent": f"""WITH {CUSTOMERS}, {SPREAD}
SELECT * FROM customers UNION ALL SELECT * FROM spread WHERE id NOT IN (SELECT id FROM customers)""",
    "upsert": f"""WITH {CUSTOMERS}, {SPREAD}
SELECT * FROM spread UNION ALL SELECT * FROM customers WHERE id NOT IN (SELECT id FROM spread)""",
    "upsert_latest": f"""WITH {CHANGES}, newest AS (
  SELECT id, name, balance FROM changes QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1
)
SELECT * FROM newest UNION ALL
SELECT s_suppkey * 3, s_name, s_acctbal FROM supplier WHERE s_suppkey * 3 NOT IN (SELECT id FROM newest)""",
    "partial_update": f"""WITH {CUSTOMERS}, {FAULTY}, newest AS (
  SELECT id * 2 AS id, max_by(name, seq) FILTER (WHERE name IS NOT NULL AND seq IS NOT NULL) AS name,
    max_by(balance, seq) FILTER (WHERE balance IS NOT NULL AND seq IS NOT NULL) AS balance
  FROM faulty GROUP BY 1
)
SELECT c.id, coalesce(n.name, c.name) AS name, coalesce(n.balance, c.balance) AS balance
FROM customers c LEFT JOIN newest n ON c.id = n.id""",
    "partial_update_rejects": f"""WITH {CUSTOMERS}, {FAULTY}, judged AS (
  SELECT f.id * 2 AS id, f.name, f.balance, f.seq, f.op,
    CASE WHEN f.id IS NULL THEN 'no key' WHEN f.seq IS NULL THEN 'no order' WHEN c.id IS NULL THEN 'missing' END AS reason
  FROM faulty f LEFT JOIN customers c ON c.id = f.id * 2
)
SELECT * FROM judged WHERE reason IS NOT NULL""",
    "delete_by_id": f"""WITH {CUSTOMERS}
SELECT * FROM customers WHERE id NOT IN (SELECT s_suppkey * 20 FROM supplier)""",
    "bulk_actions": BULK,
    "bulk_rejects": f"""WITH {JUDGED}
SELECT seq, op, id, CASE op WHEN 'create' THEN 'exists' ELSE 'missing' END AS reason FROM judged WHERE NOT valid
UNION ALL SELECT seq, op, id, 'no key' FROM faulty WHERE id IS NULL
UNION ALL SELECT seq, op, id, 'no order' FROM faulty WHERE id IS NOT NULL AND seq IS NULL
UNION ALL SELECT seq, op, id, 'repeated order' FROM counted WHERE times > 1""",
    "bulk_log_tables": BULK_LOG,
    "get_by_id": f"WITH {CUSTOMERS} SELECT * FROM customers WHERE id = {ONE_CUSTOMER}",
    "get_source": f"WITH {CUSTOMERS} SELECT name, balance FROM customers WHERE id = {ONE_CUSTOMER}",
    "exists": """SELECT l_partkey AS id, l_partkey IN (SELECT c_custkey FROM customer) AS "exists", count(*) AS asked
FROM lineitem GROUP BY 1, 2""",
    "multi_get": f"WITH {CUSTOMERS} SELECT * FROM customers WHERE id IN (SELECT l_suppkey FROM lineitem)",
    "multi_get_tables": f"""WITH {CUSTOMERS}, {PRODUCTS}
SELECT 'customers' AS _index, id, name, balance, CAST(NULL AS DOUBLE) AS price FROM customers
WHERE id IN (SELECT l_partkey FROM lineitem)
UNION ALL
SELECT 'products', id, name, NULL, price FROM products WHERE id IN (SELECT l_suppkey FROM lineitem)""",
    "match_all": f"WITH {PRODUCTS} SELECT * FROM products",
    "paged_search": f"""WITH {PRODUCTS}
SELECT * FROM products ORDER BY name, id LIMIT {PAGE_SIZE} OFFSET {PAGE_START}""",
    "page_after": f"""WITH {PRODUCTS}
SELECT * FROM products ORDER BY price, id LIMIT {PAGE_SIZE} OFFSET 1""",
    "deep_paged_search": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT {DEEP_SIZE} OFFSET {DEEP_PAGE * DEEP_SIZE}""",
    "sorted_search": f"WITH {PRODUCTS} SELECT * FROM products ORDER BY price DESC, id",
    "explode_items": """WITH parcels AS (
  SELECT l_orderkey AS id, CAST(l_partkey AS VARCHAR) AS product_id, l_extendedprice AS price, l_quantity,
    unnest(range(CAST(ceil(l_quantity / 10) AS BIGINT))) AS i
  FROM lineitem
)
SELECT id, product_id, price, least(10.0, l_quantity - i * 10) AS quantity,
  price * least(10.0, l_quantity - i * 10) AS line_total
FROM parcels""",
    "stream_silver": SILVER_ROWS,
    "stream_gold_refresh": TWEET_STATS,
    "refreshed_threads": THREADS,
    "refreshed_top_users": TOP,
    "refreshed_hourly": HOURLY,
    "refreshed_reply_stats": REPLY_STATS,
    "refreshed_hashtags": HASHTAGS,
    "stored_top_users": STORED_TOP,
    "zordered_posts": RECENT,
    "threads_bucketed": THREADS,
    "page_objects": API,
    "predictions_model": MODEL,
    "keyed_store": KEYED_STORE,
    "ingest_audit": AUDIT,
    "stream_dedupe": DEDUPE,
    "merged_tweet_stats": TWEET_STATS,
    "merged_reply_stats": REPLY_STATS,
    "merged_hashtags": HASHTAGS,
    "merged_threads": THREADS,
    "ordered_tweet_stats": _ordered(TWEET_STATS, f"{_BY_DATE}, total_tweets DESC, keyword NULLS FIRST"),
    "ordered_reply_stats": _ordered(REPLY_STATS, f"{_BY_DATE}, total_replies DESC, keyword NULLS FIRST"),
    "ordered_top_users": _ordered(TOP, "keyword NULLS FIRST, user_rank"),
    "ordered_threads": _ordered(THREADS, "conversation_total_engagement DESC NULLS LAST, tweet_id"),
    "ordered_hashtags": _ordered(HASHTAGS, f"{_BY_DATE}, keyword NULLS FIRST, hashtag_usage_count DESC, hashtag"),
    "ordered_hourly": _ordered(HOURLY, "keyword NULLS FIRST, created_day_of_week NULLS FIRST, created_hour NULLS FIRST"),
    "ordered_sentiment": _ordered(_trend("TRUE"), _TREND_ORDER),
    "ordered_sentiment_nonnull": _ordered(_trend("sentiment IS NOT NULL"), _TREND_ORDER),
}
