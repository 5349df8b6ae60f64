"""Independent DuckDB SQL for every registered query.

The Spark side goes the long way (JSON text → parsed structs → silver → gold →
metric); these texts derive the same answers straight from the driver's ``events``
view with plain SQL, so agreement checks the parsing, the fixture mapping and every
metric formula. All texts share one CTE prefix (fixture mapping, silver, gold,
latest dimensions); DuckDB only evaluates the CTEs a query references.
"""

from __future__ import annotations

import datetime as dt

START = "2024-01-01"
END = "2024-01-30"
EXTRACT_FROM = "2024-01-24"

PREFIX = r"""
WITH src AS (
    SELECT event_id, user_id,
           date_trunc('second', ts) AS created_at,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           event_id % 20 AS b,
           event_id // 20 AS j
    FROM events
),
typed AS (
    SELECT *,
        CASE WHEN b < 6 THEN 'PushEvent'
             WHEN b < 9 THEN 'PullRequestEvent'
             WHEN b < 11 THEN 'IssuesEvent'
             WHEN b < 13 THEN 'WatchEvent'
             WHEN b = 13 THEN 'IssueCommentEvent'
             WHEN b = 14 THEN 'PullRequestReviewEvent'
             WHEN b = 15 THEN 'PullRequestReviewCommentEvent'
             WHEN b = 16 THEN 'CreateEvent'
             WHEN b = 17 THEN 'ForkEvent'
             WHEN b = 18 THEN 'ReleaseEvent'
             WHEN k % 4 = 0 THEN 'DeleteEvent'
             WHEN k % 4 = 1 THEN 'CommitCommentEvent'
             WHEN k % 4 = 2 THEN 'GollumEvent'
             ELSE 'MemberEvent' END AS type,
        CASE WHEN k < 30 THEN 0 ELSE k % 40 END AS repo_id,
        CASE WHEN k < 30 THEN 0 WHEN k % 4 = 3 THEN NULL ELSE k % 7 END AS org_id
    FROM src
),
parsed AS (
    SELECT event_id AS id, type,
        CASE type
            WHEN 'PushEvent' THEN 'pushed'
            WHEN 'CreateEvent' THEN 'created'
            WHEN 'DeleteEvent' THEN 'deleted'
            WHEN 'PullRequestEvent' THEN ['opened', 'closed', 'merged', 'reopened'][j % 4 + 1]
            WHEN 'IssuesEvent' THEN ['opened', 'closed', 'labeled'][j % 3 + 1]
            WHEN 'WatchEvent' THEN 'started'
            WHEN 'ForkEvent' THEN 'forked'
            WHEN 'ReleaseEvent' THEN 'published'
            ELSE 'created' END AS action,
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS actor_id,
        CASE WHEN user_id % 7 = 0 AND created_at >= TIMESTAMP '2024-01-16 00:00:00' THEN 'r-' ELSE '' END
            || 'user' || CAST(user_id AS VARCHAR)
            || CASE user_id % 10 WHEN 0 THEN '[bot]' WHEN 1 THEN 'bot' ELSE '' END AS actor_login,
        repo_id,
        CASE WHEN repo_id = 5 AND created_at >= TIMESTAMP '2024-01-20 00:00:00' THEN 'org/renamed' ELSE 'org/repo' END
            || CAST(repo_id AS VARCHAR) AS repo_name,
        org_id,
        'org' || CAST(org_id AS VARCHAR) AS org_login,
        created_at
    FROM typed
    WHERE type NOT IN ('GollumEvent', 'MemberEvent')
),
silver AS (
    SELECT id, type, action, actor_id, repo_id, org_id, TRUE AS public, created_at,
           strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
           strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour
    FROM parsed WHERE actor_id IS NOT NULL
),
gold_counts AS (
    SELECT CAST(created_at AS DATE) AS day, repo_id, org_id,
        COUNT(*) AS total_events,
        COUNT(DISTINCT actor_id) AS unique_actors,
        COUNT(*) FILTER (WHERE type = 'PushEvent') AS push_events,
        COUNT(*) FILTER (WHERE type = 'PullRequestEvent') AS pr_events,
        COUNT(*) FILTER (WHERE type = 'IssuesEvent') AS issue_events,
        COUNT(*) FILTER (WHERE type = 'WatchEvent') AS watch_events,
        COUNT(*) FILTER (WHERE type = 'ForkEvent') AS fork_events,
        COUNT(*) FILTER (WHERE type = 'ReleaseEvent') AS release_events,
        COUNT(*) FILTER (WHERE type = 'IssueCommentEvent') AS comment_events,
        COUNT(*) FILTER (WHERE type IN ('PullRequestReviewEvent', 'PullRequestReviewCommentEvent')) AS review_events,
        COUNT(*) FILTER (WHERE type = 'PullRequestEvent' AND action = 'opened') AS prs_opened,
        COUNT(*) FILTER (WHERE type = 'PullRequestEvent' AND action = 'merged') AS prs_merged,
        COUNT(*) FILTER (WHERE type = 'PullRequestEvent' AND action = 'closed') AS prs_closed,
        COUNT(*) FILTER (WHERE type = 'IssuesEvent' AND action = 'opened') AS issues_opened,
        COUNT(*) FILTER (WHERE type = 'IssuesEvent' AND action = 'closed') AS issues_closed
    FROM silver
    GROUP BY 1, 2, 3
),
gold AS (
    SELECT day, repo_id, org_id, total_events, unique_actors, push_events, pr_events, issue_events,
        watch_events, fork_events, release_events, comment_events, review_events,
        prs_opened, prs_merged, prs_closed,
        GREATEST(prs_closed - prs_merged, 0) AS prs_closed_unmerged,
        CASE WHEN prs_merged + GREATEST(prs_closed - prs_merged, 0) > 0
             THEN prs_merged / (prs_merged + GREATEST(prs_closed - prs_merged, 0)) END AS pr_merge_rate,
        issues_opened, issues_closed,
        CASE WHEN issues_opened + issues_closed > 0
             THEN issues_closed / (issues_opened + issues_closed) END AS issue_close_rate,
        LEAST(CAST(push_events + 5 * pr_events + 3 * issue_events + 2 * watch_events AS DOUBLE), 100.0) AS activity_score,
        CAST(year(day) AS VARCHAR) AS year,
        lpad(CAST(month(day) AS VARCHAR), 2, '0') AS month
    FROM gold_counts
),
actor_versions AS (
    SELECT actor_id AS id, actor_login AS login, MIN(created_at) AS first_seen_at
    FROM parsed WHERE actor_id IS NOT NULL GROUP BY 1, 2
),
repo_versions AS (
    SELECT repo_id AS id, repo_name AS name, MIN(created_at) AS first_seen_at
    FROM parsed GROUP BY 1, 2
),
org_versions AS (
    SELECT org_id AS id, org_login AS login, MIN(created_at) AS first_seen_at
    FROM parsed WHERE org_id IS NOT NULL GROUP BY 1, 2
),
actors_latest AS (
    SELECT id, login, COALESCE(regexp_matches(login, '\[bot\]|bot$'), FALSE) AS is_bot
    FROM actor_versions
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY first_seen_at DESC, login DESC) = 1
),
repos_latest AS (
    SELECT id, name FROM repo_versions
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY first_seen_at DESC, name DESC) = 1
),
orgs_latest AS (
    SELECT id, login FROM org_versions
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY first_seen_at DESC, login DESC) = 1
),
gw AS (
    SELECT * FROM gold WHERE day BETWEEN DATE '{start}' AND DATE '{end}'
),
sw AS (
    SELECT * FROM silver
    WHERE created_at BETWEEN TIMESTAMP '{start} 00:00:00' AND TIMESTAMP '{end} 00:00:00'
)
"""


def r(expr: str, digits: int) -> str:
    """Half-even rounding on the binary double, same steps as the Spark helper."""
    scale = 10**digits
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def s6(expr: str) -> str:
    return r(expr, 6)


def with_prefix(body: str, start: str = START, end: str = END) -> str:
    return PREFIX.replace("{start}", start).replace("{end}", end) + body


def _heat_start(end: str) -> str:
    return str(dt.date.fromisoformat(end) - dt.timedelta(days=7))


GOLD_COLUMNS = (
    "day, repo_id, org_id, total_events, unique_actors, push_events, pr_events, issue_events, watch_events, "
    "fork_events, release_events, comment_events, review_events, prs_opened, prs_merged, prs_closed, "
    "prs_closed_unmerged, pr_merge_rate, issues_opened, issues_closed, issue_close_rate, activity_score, year, month"
)

SERVING: dict[str, str] = {
    "overview_kpis": f"""
SELECT g.*, s.unique_contributors FROM (
    SELECT CAST(COALESCE(SUM(total_events), 0) AS BIGINT) AS total_events,
           COUNT(DISTINCT repo_id) AS active_repos,
           {s6('AVG(pr_merge_rate)')} AS avg_pr_merge_rate,
           {s6('AVG(issue_close_rate)')} AS avg_issue_close_rate,
           {s6('AVG(activity_score)')} AS avg_activity_score
    FROM gw) g,
    (SELECT COUNT(DISTINCT actor_id) AS unique_contributors FROM sw) s
""",
    "daily_timeline": """
SELECT day, CAST(SUM(total_events) AS BIGINT) AS total_events FROM gw GROUP BY day ORDER BY day
""",
    "event_type_distribution": """
SELECT label, CAST(count AS BIGINT) AS count FROM (
    SELECT 1 AS pos, 'Push' AS label, COALESCE(SUM(push_events), 0) AS count FROM gw
    UNION ALL SELECT 2, 'Pull Request', COALESCE(SUM(pr_events), 0) FROM gw
    UNION ALL SELECT 3, 'Issue', COALESCE(SUM(issue_events), 0) FROM gw
    UNION ALL SELECT 4, 'Watch/Star', COALESCE(SUM(watch_events), 0) FROM gw
    UNION ALL SELECT 5, 'Fork', COALESCE(SUM(fork_events), 0) FROM gw
    UNION ALL SELECT 6, 'Release', COALESCE(SUM(release_events), 0) FROM gw
    UNION ALL SELECT 7, 'Comment', COALESCE(SUM(comment_events), 0) FROM gw
    UNION ALL SELECT 8, 'Review', COALESCE(SUM(review_events), 0) FROM gw
) ORDER BY pos
""",
    "daily_event_breakdown": f"""
SELECT day,
       CAST(SUM(push_events) AS BIGINT) AS push_events,
       CAST(SUM(pr_events) AS BIGINT) AS pr_events,
       CAST(SUM(issue_events) AS BIGINT) AS issue_events,
       CAST(SUM(watch_events) AS BIGINT) AS watch_events,
       CAST(SUM(fork_events) AS BIGINT) AS fork_events,
       {s6('AVG(activity_score)')} AS avg_activity_score
FROM gw GROUP BY day ORDER BY day
""",
    "top_repos": f"""
SELECT r.name AS repo_name, t.total_events, {r('t.avg_score', 1)} AS avg_score
FROM (SELECT repo_id, CAST(SUM(total_events) AS BIGINT) AS total_events, AVG(activity_score) AS avg_score
      FROM gw GROUP BY repo_id ORDER BY total_events DESC, repo_id LIMIT 10) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
ORDER BY t.total_events DESC, t.repo_id
""",
    "trending_repos": """
SELECT r.name AS repo_name, t.stars_gained, t.active_days
FROM (SELECT repo_id, CAST(SUM(watch_events) AS BIGINT) AS stars_gained, COUNT(DISTINCT day) AS active_days
      FROM gw GROUP BY repo_id HAVING SUM(watch_events) > 0
      ORDER BY stars_gained DESC, repo_id LIMIT 10) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
ORDER BY t.stars_gained DESC, t.repo_id
""",
    "top_contributors": """
SELECT a.login, a.is_bot, COUNT(*) AS events, COUNT(DISTINCT e.repo_id) AS repos,
       COUNT(*) FILTER (WHERE e.type = 'PullRequestEvent') AS prs
FROM sw e LEFT JOIN actors_latest a ON a.id = e.actor_id
GROUP BY a.login, a.is_bot
ORDER BY events DESC, a.login NULLS FIRST, a.is_bot NULLS FIRST
LIMIT 50
""",
    "contributors_over_time": """
SELECT CAST(e.created_at AS DATE) AS day, a.is_bot, COUNT(DISTINCT e.actor_id) AS contributors
FROM sw e LEFT JOIN actors_latest a ON a.id = e.actor_id
GROUP BY 1, 2 ORDER BY 1, 2
""",
    "bot_vs_human": """
SELECT CAST(e.created_at AS DATE) AS day, a.is_bot, COUNT(*) AS events
FROM sw e LEFT JOIN actors_latest a ON a.id = e.actor_id
GROUP BY 1, 2 ORDER BY 1, 2
""",
    "pr_metrics": f"""
SELECT day, CAST(SUM(prs_opened) AS BIGINT) AS prs_opened, CAST(SUM(prs_merged) AS BIGINT) AS prs_merged,
       CAST(SUM(prs_closed_unmerged) AS BIGINT) AS prs_closed_unmerged,
       {s6('AVG(pr_merge_rate)')} AS avg_merge_rate
FROM gw GROUP BY day ORDER BY day
""",
    "pr_bot_breakdown": """
SELECT CAST(e.created_at AS DATE) AS day, a.is_bot, COUNT(*) AS prs
FROM sw e LEFT JOIN actors_latest a ON a.id = e.actor_id
WHERE e.type = 'PullRequestEvent'
GROUP BY 1, 2 ORDER BY 1, 2
""",
    "issue_metrics": f"""
SELECT day, CAST(SUM(issues_opened) AS BIGINT) AS issues_opened, CAST(SUM(issues_closed) AS BIGINT) AS issues_closed,
       {s6('AVG(issue_close_rate)')} AS avg_close_rate
FROM gw GROUP BY day ORDER BY day
""",
    "code_review_metrics": """
SELECT day, CAST(SUM(pr_events) AS BIGINT) AS pr_events, CAST(SUM(review_events) AS BIGINT) AS review_events,
       CAST(SUM(comment_events) AS BIGINT) AS comment_events
FROM gw GROUP BY day ORDER BY day
""",
    "repo_health": f"""
SELECT r.name AS repo_name, t.total_events, {r('t.avg_score', 1)} AS avg_score,
       {r('t.avg_merge_rate', 3)} AS avg_merge_rate, {r('t.avg_close_rate', 3)} AS avg_close_rate,
       CASE WHEN t.total_prs > 0 THEN {r('t.total_reviews / t.total_prs', 2)} END AS review_per_pr
FROM (SELECT repo_id, CAST(SUM(total_events) AS BIGINT) AS total_events, AVG(activity_score) AS avg_score,
             AVG(pr_merge_rate) AS avg_merge_rate, AVG(issue_close_rate) AS avg_close_rate,
             SUM(review_events) AS total_reviews, SUM(pr_events) AS total_prs
      FROM gw GROUP BY repo_id ORDER BY total_events DESC, repo_id LIMIT 10) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
ORDER BY t.total_events DESC, t.repo_id
""",
    "ecosystem_kpis": f"""
SELECT t.active_repos, t.total_stars, t.total_forks, t.avg_activity_score, t.unique_actors,
       {r('COALESCE(d.avg_stars, 0.0)', 1)} AS avg_stars_per_day,
       {r('COALESCE(d.avg_active, 0.0)', 1)} AS avg_active_repos_per_day,
       CASE WHEN t.total_forks > 0 THEN {r('t.total_stars / t.total_forks', 1)} END AS star_fork_ratio
FROM (SELECT COUNT(DISTINCT repo_id) AS active_repos,
             CAST(COALESCE(SUM(watch_events), 0) AS BIGINT) AS total_stars,
             CAST(COALESCE(SUM(fork_events), 0) AS BIGINT) AS total_forks,
             {r('AVG(activity_score)', 1)} AS avg_activity_score,
             CAST(COALESCE(SUM(unique_actors), 0) AS BIGINT) AS unique_actors
      FROM gw) t,
     (SELECT AVG(stars) AS avg_stars, AVG(active) AS avg_active
      FROM (SELECT day, SUM(watch_events) AS stars, COUNT(DISTINCT repo_id) AS active FROM gw GROUP BY day)) d
""",
    "org_summary": f"""
SELECT o.login AS org_name, t.total_events, t.active_repos, {r('t.avg_score', 1)} AS avg_activity_score
FROM (SELECT org_id, CAST(SUM(total_events) AS BIGINT) AS total_events, COUNT(DISTINCT repo_id) AS active_repos,
             AVG(activity_score) AS avg_score
      FROM gw WHERE org_id IS NOT NULL GROUP BY org_id) t
LEFT JOIN orgs_latest o ON o.id = t.org_id
ORDER BY t.total_events DESC, t.org_id
""",
    "active_repos_over_time": """
SELECT day, COUNT(DISTINCT repo_id) AS active_repos FROM gw GROUP BY day ORDER BY day
""",
    "star_growth": """
SELECT day, stars, CAST(SUM(stars) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_stars
FROM (SELECT day, CAST(SUM(watch_events) AS BIGINT) AS stars FROM gw GROUP BY day) ORDER BY day
""",
    "fork_growth": """
SELECT day, forks, CAST(SUM(forks) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_forks
FROM (SELECT day, CAST(SUM(fork_events) AS BIGINT) AS forks FROM gw GROUP BY day) ORDER BY day
""",
    "top_forked_repos": """
SELECT r.name AS repo_name, t.forks
FROM (SELECT repo_id, CAST(SUM(fork_events) AS BIGINT) AS forks FROM gw GROUP BY repo_id
      HAVING SUM(fork_events) > 0 ORDER BY forks DESC, repo_id LIMIT 10) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
ORDER BY t.forks DESC, t.repo_id
""",
    "top_open_repos_by_issues": """
SELECT r.name AS repo_name, t.issues_opened, t.prs_opened
FROM (SELECT repo_id, CAST(SUM(issues_opened) AS BIGINT) AS issues_opened, CAST(SUM(prs_opened) AS BIGINT) AS prs_opened
      FROM gw GROUP BY repo_id ORDER BY issues_opened DESC, repo_id LIMIT 10) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
ORDER BY t.issues_opened DESC, t.repo_id
""",
    "top_open_repos_by_prs": """
SELECT r.name AS repo_name, t.issues_opened, t.prs_opened
FROM (SELECT repo_id, CAST(SUM(issues_opened) AS BIGINT) AS issues_opened, CAST(SUM(prs_opened) AS BIGINT) AS prs_opened
      FROM gw GROUP BY repo_id ORDER BY prs_opened DESC, repo_id LIMIT 10) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
ORDER BY t.prs_opened DESC, t.repo_id
""",
    "stars_vs_forks": """
, first_org AS (
    SELECT repo_id, org_id FROM gw
    QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY day, org_id NULLS LAST) = 1
)
SELECT r.name AS repo_name, t.stars_gained, t.forks, o.login AS org_name
FROM (SELECT g.repo_id, CAST(SUM(watch_events) AS BIGINT) AS stars_gained, CAST(SUM(fork_events) AS BIGINT) AS forks,
             ANY_VALUE(f.org_id) AS org_id
      FROM gw g JOIN first_org f USING (repo_id)
      GROUP BY g.repo_id HAVING SUM(watch_events) > 0 OR SUM(fork_events) > 0
      ORDER BY stars_gained DESC, g.repo_id LIMIT 60) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
LEFT JOIN orgs_latest o ON o.id = t.org_id
ORDER BY t.stars_gained DESC, t.repo_id
""",
    "star_engagement": f"""
, first_org AS (
    SELECT repo_id, org_id FROM gw
    QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY day, org_id NULLS LAST) = 1
)
SELECT r.name AS repo_name, t.stars, t.engagement,
       CASE WHEN t.stars > 0 THEN {r('t.engagement / t.stars', 3)} END AS conversion_rate,
       o.login AS org_name
FROM (SELECT g.repo_id, CAST(SUM(watch_events) AS BIGINT) AS stars,
             CAST(SUM(pr_events) + SUM(issue_events) AS BIGINT) AS engagement,
             ANY_VALUE(f.org_id) AS org_id
      FROM gw g JOIN first_org f USING (repo_id)
      GROUP BY g.repo_id HAVING SUM(watch_events) > 0
      ORDER BY stars DESC, g.repo_id LIMIT 20) t
LEFT JOIN repos_latest r ON r.id = t.repo_id
LEFT JOIN orgs_latest o ON o.id = t.org_id
ORDER BY t.stars DESC, t.repo_id
""",
    "date_range": """
SELECT MIN(day) AS min_day, MAX(day) AS max_day FROM gold
""",
    "daily_activity": f"""
SELECT {GOLD_COLUMNS} FROM gold
""",
}


def heatmap_sql(end: str, event_type: str | None = None) -> str:
    body = f"""
, hw AS (
    SELECT * FROM silver
    WHERE created_at BETWEEN TIMESTAMP '{_heat_start(end)} 00:00:00' AND TIMESTAMP '{end} 00:00:00'
    {"AND type = '" + event_type + "'" if event_type else ""}
)
SELECT CAST(dayofweek(created_at) AS SMALLINT) AS dow, CAST(hour(created_at) AS SMALLINT) AS hour, COUNT(*) AS events
FROM hw GROUP BY 1, 2 ORDER BY 1, 2
"""
    return body


def _q(name: str, alias: str = "q") -> str:
    """A serving query's body as an extra CTE."""
    return f", {alias} AS ({SERVING[name].strip()})\n"


def _pivot(src: str, value: str) -> str:
    return _q(src) + f"""
SELECT day,
       CAST(COALESCE(SUM({value}) FILTER (WHERE NOT is_bot), 0) AS BIGINT) AS human,
       CAST(COALESCE(SUM({value}) FILTER (WHERE is_bot), 0) AS BIGINT) AS bot
FROM q WHERE is_bot IS NOT NULL GROUP BY day ORDER BY day
"""


def _top_group(is_bot: bool) -> str:
    return _q("top_contributors") + f"""
SELECT login, is_bot, events, repos, prs,
       row_number() OVER (PARTITION BY is_bot ORDER BY events DESC, login) AS rank
FROM q WHERE is_bot = {str(is_bot).upper()}
QUALIFY rank <= 10
"""


def _org_head(n: int) -> str:
    return f"""
SELECT o.login AS org_name, t.total_events, t.active_repos, {r('t.avg_score', 1)} AS avg_activity_score
FROM (SELECT org_id, CAST(SUM(total_events) AS BIGINT) AS total_events, COUNT(DISTINCT repo_id) AS active_repos,
             AVG(activity_score) AS avg_score
      FROM gw WHERE org_id IS NOT NULL GROUP BY org_id ORDER BY total_events DESC, org_id LIMIT {n}) t
LEFT JOIN orgs_latest o ON o.id = t.org_id
ORDER BY t.total_events DESC, t.org_id
"""


DERIVED: dict[str, str] = {
    "contributors_bot_human": _pivot("contributors_over_time", "contributors"),
    "events_bot_human": _pivot("bot_vs_human", "events"),
    "prs_bot_human": _pivot("pr_bot_breakdown", "prs"),
    "bot_human_totals": _q("bot_vs_human") + """
SELECT CAST(COALESCE(SUM(events) FILTER (WHERE is_bot = FALSE), 0) AS BIGINT) AS human_events,
       CAST(COALESCE(SUM(events) FILTER (WHERE is_bot), 0) AS BIGINT) AS bot_events
FROM q
""",
    "heatmap_grid": heatmap_sql(END).replace("SELECT CAST(dayofweek", ", heat AS (SELECT CAST(dayofweek", 1).rstrip().removesuffix("ORDER BY 1, 2")
    + """)
, grid AS (SELECT CAST(i // 24 AS SMALLINT) AS dow, CAST(i % 24 AS SMALLINT) AS hour FROM (SELECT range AS i FROM range(168)))
, cells AS (SELECT g.dow, g.hour, CAST(COALESCE(h.events, 0) AS BIGINT) AS events FROM grid g LEFT JOIN heat h USING (dow, hour))
, st AS (SELECT MAX(events) AS max_events, list_sort(list(events) FILTER (WHERE events > 0)) AS nz FROM cells)
, med AS (SELECT max_events, CAST(CASE WHEN len(nz) > 0 THEN nz[len(nz) // 2 + 1] ELSE 0 END AS BIGINT) AS median_nonzero FROM st)
SELECT c.dow, c.hour, c.events, m.max_events, m.median_nonzero, CAST(m.median_nonzero AS DOUBLE) * 0.85 AS floor
FROM cells c, med m ORDER BY 1, 2
""",
    "top_humans": _top_group(False),
    "top_bots": _top_group(True),
    "pr_funnel": _q("pr_metrics") + """
, t AS (SELECT CAST(COALESCE(SUM(prs_opened), 0) AS BIGINT) AS o, CAST(COALESCE(SUM(prs_merged), 0) AS BIGINT) AS m,
               CAST(COALESCE(SUM(prs_closed_unmerged), 0) AS BIGINT) AS c FROM q)
SELECT 'Opened' AS stage, o AS count FROM t
UNION ALL SELECT 'Merged', m FROM t
UNION ALL SELECT 'Closed w/o merge', c FROM t
UNION ALL SELECT 'Still open', GREATEST(o - m - c, 0) FROM t
""",
    "merge_rate_pct": _q("pr_metrics") + f"SELECT day, {r('avg_merge_rate * 100.0', 1)} AS merge_rate_pct FROM q ORDER BY day\n",
    "close_rate_pct": _q("issue_metrics") + f"SELECT day, {r('avg_close_rate * 100.0', 1)} AS close_rate_pct FROM q ORDER BY day\n",
    "period_mean_rates": _q("pr_metrics", "p") + _q("issue_metrics", "i") + f"""
SELECT (SELECT {s6('AVG(avg_merge_rate)')} FROM p) AS overall_merge_rate,
       (SELECT {s6('AVG(avg_close_rate)')} FROM i) AS overall_close_rate
""",
    "review_totals": _q("code_review_metrics") + f"""
, t AS (SELECT CAST(COALESCE(SUM(review_events), 0) AS BIGINT) AS total_reviews,
               CAST(COALESCE(SUM(comment_events), 0) AS BIGINT) AS total_comments,
               CAST(COALESCE(SUM(pr_events), 0) AS BIGINT) AS total_prs FROM q)
SELECT *, CASE WHEN total_prs > 0 THEN {r('total_reviews / total_prs', 2)} END AS reviews_per_pr,
          CASE WHEN total_prs > 0 THEN {r('total_comments / total_prs', 2)} END AS comments_per_pr
FROM t
""",
    "review_ratios": _q("code_review_metrics") + f"""
SELECT day, CASE WHEN pr_events > 0 THEN {r('review_events / pr_events', 2)} END AS reviews_per_pr,
            CASE WHEN pr_events > 0 THEN {r('comment_events / pr_events', 2)} END AS comments_per_pr
FROM q ORDER BY day
""",
    "score_bands": _q("daily_event_breakdown") + f"""
SELECT day, {r('avg_activity_score', 2)} AS score,
       CASE WHEN {r('avg_activity_score', 2)} <= 30 THEN 'low'
            WHEN {r('avg_activity_score', 2)} <= 60 THEN 'average' ELSE 'good' END AS band
FROM q ORDER BY day
""",
    "distribution_share": _q("event_type_distribution") + f"""
SELECT label, count, {s6('count * 100.0 / SUM(count) OVER ()')} AS share_pct FROM q WHERE count > 0
""",
    "org_top10": _org_head(10),
    "org_top100": _org_head(100),
    "stars_vs_forks_labeled": SERVING["stars_vs_forks"].replace("o.login AS org_name", "COALESCE(o.login, 'n/a') AS org_name"),
    "default_range": """
SELECT GREATEST(MIN(day), CAST(MAX(day) - INTERVAL 30 DAY AS DATE)) AS start_day, MAX(day) AS end_day FROM gold
""",
}


COPIES = """
, copies AS (SELECT * FROM typed UNION ALL SELECT * FROM typed WHERE event_id % 50 = 0)
"""

ACTORS_FULL = """
, actors_full AS (
    SELECT id, login, login AS display_login, '' AS gravatar_id, 'https://api.github.com/users/' || login AS url,
           'https://avatars.githubusercontent.com/u/' || CAST(id AS VARCHAR) || '?' AS avatar_url,
           COALESCE(regexp_matches(login, '\\[bot\\]|bot$'), FALSE) AS is_bot, first_seen_at,
           TIMESTAMP '2024-02-01 00:00:00' AS inserted_at
    FROM actor_versions
)
, repos_full AS (
    SELECT id, name, 'https://api.github.com/repos/' || name AS url, first_seen_at,
           TIMESTAMP '2024-02-01 00:00:00' AS inserted_at
    FROM repo_versions
)
, orgs_full AS (
    SELECT id, login, '' AS gravatar_id, 'https://api.github.com/orgs/' || login AS url,
           'https://avatars.githubusercontent.com/u/' || CAST(id AS VARCHAR) || '?' AS avatar_url, first_seen_at,
           TIMESTAMP '2024-02-01 00:00:00' AS inserted_at
    FROM org_versions
)
, gold_full AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS updated_at FROM gold)
, bronze_rows AS (
    SELECT CAST(event_id AS VARCHAR) AS id, type, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM copies
)
"""

KNOWN = "('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'WatchEvent', 'IssueCommentEvent', 'PullRequestReviewEvent', 'PullRequestReviewCommentEvent', 'CreateEvent', 'DeleteEvent', 'ForkEvent', 'ReleaseEvent', 'CommitCommentEvent')"

# Events built without the type filter: unknown types keep a null action.
UNFILTERED = """
, unfiltered AS (
    SELECT s.id, t.type, s.action, s.actor_id, s.repo_id, s.org_id, s.public, s.created_at,
           s.year, s.month, s.day, s.hour
    FROM (SELECT event_id AS id, type,
                 CASE WHEN type IN ('GollumEvent', 'MemberEvent') THEN NULL END AS action_override
          FROM typed) t
    JOIN (
        SELECT event_id AS id, NULL::VARCHAR AS action, CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS actor_id,
               repo_id, org_id, TRUE AS public, created_at,
               strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
               strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour
        FROM typed WHERE type IN ('GollumEvent', 'MemberEvent')
        UNION ALL
        SELECT id, action, actor_id, repo_id, org_id, public, created_at, year, month, day, hour FROM silver
    ) s USING (id)
    WHERE s.actor_id IS NOT NULL
)
"""


def _contract_sql(table: str, contract_name: str) -> str:
    from vitals.operators.contracts import ALL, sql_check

    return COPIES + ACTORS_FULL + UNFILTERED + sql_check(table, ALL[contract_name])


def _pending_days_sql(wm: str) -> str:
    return f"""
SELECT DISTINCT CAST(created_at AS DATE) AS day FROM silver
WHERE created_at > TIMESTAMP '{wm} 00:00:00' ORDER BY day
"""


OPS: dict[str, str] = {
    "filter_known_events": COPIES + f"""
SELECT CAST(event_id AS VARCHAR) AS id, type, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, TRUE AS public
FROM copies WHERE type IN {KNOWN}
""",
    "parse_structs": """
SELECT CAST(p.id AS VARCHAR) AS id, p.actor_id,
       CASE WHEN p.actor_id IS NULL THEN NULL ELSE p.actor_login END AS actor_login,
       p.repo_id, p.repo_name, p.org_id, CASE WHEN p.org_id IS NULL THEN NULL ELSE p.org_login END AS org_login,
       p.created_at
FROM parsed p JOIN (SELECT 1 AS c UNION ALL SELECT 2) k ON k.c = 1 OR p.id % 50 = 0
""",
    "parse_created_at": COPIES + """
SELECT CAST(event_id AS VARCHAR) AS id, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at_text, created_at
FROM copies
""",
    "dedup_events": """
SELECT CAST(id AS VARCHAR) AS id, type, created_at FROM parsed
""",
    "extract_action": """
SELECT CAST(id AS VARCHAR) AS id, type, action FROM parsed
""",
    "build_events": """
SELECT id, type, action, actor_id, repo_id, org_id, public, created_at, year, month, day, hour FROM silver
""",
    "detect_bot": """
SELECT DISTINCT login, COALESCE(regexp_matches(login, '\\[bot\\]|bot$'), FALSE) AS is_bot FROM actor_versions
""",
    "build_actors": ACTORS_FULL + """
SELECT id, login, display_login, gravatar_id, url, avatar_url, is_bot, first_seen_at FROM actors_full
""",
    "build_repos": ACTORS_FULL + """
SELECT id, name, url, first_seen_at FROM repos_full
""",
    "build_orgs": ACTORS_FULL + """
SELECT id, login, gravatar_id, url, avatar_url, first_seen_at FROM orgs_full
""",
    "filter_scd1": """
, a_old AS (SELECT DISTINCT actor_id AS id, actor_login AS login FROM parsed
            WHERE actor_id IS NOT NULL AND date_trunc('hour', created_at) < TIMESTAMP '2024-01-16 00:00:00')
, a_new AS (SELECT DISTINCT actor_id AS id, actor_login AS login FROM parsed
            WHERE actor_id IS NOT NULL AND date_trunc('hour', created_at) >= TIMESTAMP '2024-01-16 00:00:00')
SELECT n.id, n.login, COALESCE(regexp_matches(n.login, '\\[bot\\]|bot$'), FALSE) AS is_bot
FROM a_new n ANTI JOIN a_old o ON o.id = n.id AND o.login = n.login
""",
    "latest_actors": "SELECT id, login, is_bot FROM actors_latest",
    "latest_repos": "SELECT id, name FROM repos_latest",
    "latest_orgs": "SELECT id, login FROM orgs_latest",
    "contract_bronze": _contract_sql("bronze_rows", "bronze"),
    "contract_events": _contract_sql("silver", "events"),
    "contract_actors": _contract_sql("actors_full", "actors"),
    "contract_repos": _contract_sql("repos_full", "repos"),
    "contract_orgs": _contract_sql("orgs_full", "orgs"),
    "contract_gold": _contract_sql("gold_full", "gold"),
    "contract_events_unfiltered": _contract_sql("unfiltered", "events"),
    "violation_sample": UNFILTERED + f"""
SELECT id, type, action,
       CAST((type NOT IN {KNOWN})::INT + (action IS NULL)::INT AS BIGINT) AS n_failed
FROM unfiltered
WHERE type NOT IN {KNOWN} OR action IS NULL
ORDER BY id LIMIT 20
""",
    "pending_partitions": """
SELECT DISTINCT strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
       strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour
FROM typed WHERE date_trunc('hour', created_at) >= TIMESTAMP '2024-01-20 00:00:00'
ORDER BY 1, 2, 3, 4
""",
    "gold_watermark": """
SELECT COALESCE(MAX(day), DATE '2014-12-31') AS watermark FROM gold WHERE day <= DATE '2024-01-20'
""",
    "pending_days": _pending_days_sql("2024-01-20"),
    "batches": f"""
, pd AS ({_pending_days_sql("2024-01-20").strip()})
SELECT batch, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS n_days
FROM (SELECT day, (row_number() OVER (ORDER BY day) - 1) // 2 AS batch FROM pd)
GROUP BY batch ORDER BY batch
""",
    "read_events_for_days": """
SELECT type, action, actor_id, repo_id, org_id, created_at FROM silver
WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-20' AND DATE '2024-01-21'
""",
}


PAYLOAD_ACTION = """
CASE type
    WHEN 'PullRequestEvent' THEN ['opened', 'closed', 'merged', 'reopened'][j % 4 + 1]
    WHEN 'IssuesEvent' THEN ['opened', 'closed', 'labeled'][j % 3 + 1]
    WHEN 'WatchEvent' THEN 'started'
    WHEN 'IssueCommentEvent' THEN 'created'
    WHEN 'PullRequestReviewEvent' THEN 'created'
    WHEN 'PullRequestReviewCommentEvent' THEN 'created'
    WHEN 'ForkEvent' THEN 'forked'
    WHEN 'ReleaseEvent' THEN 'published'
END"""

ARCHIVE_FILE = "strftime(created_at, '%Y-%m-%d') || '-' || CAST(hour(created_at) AS VARCHAR) || '.json.gz'"
LOGIN = """CASE WHEN event_id % 97 = 0 THEN NULL ELSE
    CASE WHEN user_id % 7 = 0 AND created_at >= TIMESTAMP '2024-01-16 00:00:00' THEN 'r-' ELSE '' END
    || 'user' || CAST(user_id AS VARCHAR)
    || CASE user_id % 10 WHEN 0 THEN '[bot]' WHEN 1 THEN 'bot' ELSE '' END END"""

_HOURS = """
, bounds AS (SELECT date_trunc('day', MAX(ts)) - INTERVAL 30 DAY AS lo, date_trunc('hour', MAX(ts)) AS hi FROM events)
, hrs AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS TIMESTAMP) AS hour_ts FROM bounds)
"""

WRITES: dict[str, str] = {
    "read_raw_events": COPIES + f"""
SELECT CAST(event_id AS VARCHAR) AS id, type, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, TRUE AS public,
       {LOGIN} AS actor_login, {PAYLOAD_ACTION} AS payload_action, {ARCHIVE_FILE} AS archive_file
FROM copies
""",
    "land_bronze": COPIES + f"""
SELECT CAST(event_id AS VARCHAR) AS id, type, strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
       strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour, {ARCHIVE_FILE} AS archive_file
FROM copies
""",
    "hours_to_ingest": _HOURS + "SELECT hour_ts FROM hrs",
    "skip_existing_hours": _HOURS + """
, avail AS (SELECT DISTINCT date_trunc('hour', created_at) AS h FROM typed)
SELECT hour_ts,
       CASE WHEN hour_ts < TIMESTAMP '2024-01-16 00:00:00' AND hour_ts IN (SELECT h FROM avail) THEN 'skipped'
            WHEN hour_ts NOT IN (SELECT h FROM avail) THEN 'skipped' ELSE 'success' END AS status,
       CASE WHEN hour_ts < TIMESTAMP '2024-01-16 00:00:00' AND hour_ts IN (SELECT h FROM avail) THEN 'already landed'
            WHEN hour_ts NOT IN (SELECT h FROM avail) THEN 'source missing' ELSE 'landed' END AS reason
FROM hrs
""",
    "read_bronze_partitions": COPIES + """
SELECT CAST(event_id AS VARCHAR) AS id, type, strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
       strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour
FROM copies WHERE date_trunc('hour', created_at) >= TIMESTAMP '2024-01-20 00:00:00'
""",
}
_EVENTS_ALL = "SELECT id, type, action, actor_id, repo_id, org_id, public, created_at, year, month, day, hour FROM silver"
_GOLD_NO_CLOCK = f"SELECT {GOLD_COLUMNS} FROM gold"
WRITES["append_fact"] = _EVENTS_ALL
WRITES["transform_batch"] = _EVENTS_ALL
WRITES["stream_silver"] = _EVENTS_ALL
WRITES["stream_silver_redelivered"] = _EVENTS_ALL
WRITES["silver_to_gold"] = _GOLD_NO_CLOCK
WRITES["replace_days"] = _GOLD_NO_CLOCK
WRITES["stream_gold"] = _GOLD_NO_CLOCK
WRITES["export_gold_window"] = _GOLD_NO_CLOCK + " WHERE day BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'"
WRITES["export_events_window"] = """
SELECT id, type, action, actor_id, repo_id, org_id, public, created_at, CAST(created_at AS DATE) AS date FROM silver
WHERE created_at BETWEEN TIMESTAMP '2024-01-23 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'
"""
WRITES["csv_download"] = (
    _org_head(100)
    .replace("o.login AS org_name", 'o.login AS "Organization"')
    .replace("t.total_events, t.active_repos,", 't.total_events AS "Total events", t.active_repos AS "Active repos",')
    .replace("AS avg_activity_score", 'AS "Avg activity score"')
)


_COLUMNS = "event_id, user_id, ts, props"
_NEW = 29_100_000_000


def _over(body: str, events: str) -> str:
    """``body`` over other events than the whole table."""
    return with_prefix(body).replace("FROM events\n", f"FROM ({events})\n", 1)


_WITH_NEW = f"SELECT {_COLUMNS} FROM events UNION ALL SELECT event_id + {_NEW}, user_id, ts, props FROM events WHERE event_id % 25 = 0"
_RELANDED = f"""
SELECT {_COLUMNS} FROM events
WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-10', DATE '2024-01-12') OR CAST(ts AS DATE) = DATE '2024-01-10' AND (event_id % 2 = 0 OR event_id % 10 = 1)
UNION ALL SELECT event_id + {_NEW}, user_id, ts, props FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND event_id % 25 = 0
"""

REJECTS = COPIES + f"""
, judged AS (
    SELECT CASE WHEN event_id % 223 = 0 THEN 'evt_' ELSE '' END || CAST(event_id AS VARCHAR) AS id, strftime(created_at, '%Y-%m-%d-%H') AS source,
        concat_ws('; ', CASE WHEN event_id % 223 = 0 THEN 'id malformed' END,
            CASE WHEN event_id % 97 = 0 THEN 'actor missing' WHEN event_id % 211 = 0 THEN 'actor malformed' END,
            CASE WHEN event_id % 229 = 0 THEN 'repo malformed' END,
            CASE WHEN event_id % 233 = 0 AND org_id IS NOT NULL THEN 'org malformed' END,
            CASE WHEN event_id % 227 = 0 THEN 'time malformed' END) AS reasons
    FROM copies WHERE type IN {KNOWN})
SELECT id, source, reasons FROM judged WHERE reasons <> ''
"""

INGEST = COPIES + _HOURS + """
, held AS (SELECT date_trunc('hour', created_at) AS h, COUNT(*) AS n FROM copies GROUP BY 1
           UNION ALL SELECT TIMESTAMP '2024-01-21 03:00:00', 1)
, avail AS (SELECT h, SUM(n)::BIGINT AS n FROM held GROUP BY 1)
, stated AS (
    SELECT hour_ts, n, CASE WHEN n IS NULL OR hour_ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'skipped'
        WHEN hour_ts BETWEEN TIMESTAMP '2024-01-20 05:00:00' AND TIMESTAMP '2024-01-20 07:00:00' THEN 'failed' ELSE 'success' END AS status
    FROM hrs LEFT JOIN avail ON h = hour_ts)
SELECT hour_ts, status, CASE WHEN n IS NULL THEN 'source missing' WHEN status = 'skipped' THEN 'already landed' WHEN status = 'failed' THEN 'cut off' ELSE 'landed' END AS reason,
    CASE WHEN status = 'success' THEN n END AS n_rows, CASE WHEN status = 'success' THEN (hour_ts = TIMESTAMP '2024-01-21 03:00:00')::BIGINT END AS n_corrupt
FROM stated
"""


ROLLING = """
SELECT d.day, COUNT(DISTINCT s.actor_id) AS actors, COUNT(DISTINCT s.repo_id) AS repos
FROM (SELECT DISTINCT CAST(created_at AS DATE) AS day FROM silver) d
JOIN silver s ON CAST(s.created_at AS DATE) BETWEEN d.day - 6 AND d.day
GROUP BY 1
"""


def _histories() -> dict[str, str]:
    return {
        "dedup_across_batches": _over(_EVENTS_ALL, _WITH_NEW),
        "late_days": _over(_GOLD_NO_CLOCK, _WITH_NEW),
        "relanded_hour": _over(_EVENTS_ALL, _RELANDED),
        "relanded_gold": _over(_GOLD_NO_CLOCK, _RELANDED),
        "silver_rejects": with_prefix(REJECTS),
        "transform_in_batches": with_prefix(_EVENTS_ALL),
        "ingest_status": with_prefix(INGEST),
        "overview_kpis_from_bitmaps": with_prefix(SERVING["overview_kpis"]),
        "rolling_distincts": with_prefix(ROLLING),
        "read_table_extract": with_prefix(SERVING["bot_vs_human"], EXTRACT_FROM, END),
    }


def all_sql() -> dict[str, str]:
    out = {name: with_prefix(body) for name, body in SERVING.items()}
    out["activity_heatmap"] = with_prefix(heatmap_sql(END))
    out["activity_heatmap_push"] = with_prefix(heatmap_sql(END, "PushEvent"))
    out.update({name: with_prefix(body) for name, body in DERIVED.items()})
    out.update({name: with_prefix(body) for name, body in OPS.items()})
    out.update({name: with_prefix(body) for name, body in WRITES.items()})
    out.update(_histories())
    return out
