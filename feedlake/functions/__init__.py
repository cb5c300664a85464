"""Column functions (no session needed): URL, text, HTML, date, status."""

from .dates import (iso_seconds, iso_z, parse_feed_date, run_date, run_id, state_run_id)
from .html import (anchor_href, anchor_text, anchors, body_text, canonical_link,
                   fragment_text, is_challenge_page, strip_non_text, time_datetime, title_text, unescape)
from .status import error_type, fetch_status, processing_status, with_freshness
from .text import (bullets, clean_whitespace, content_hash, first_non_blank,
                   first_sentences, key_takeaway, normalize_text, short_id,
                   strip_ws, summary_prompt, topic_tags, trim_text)
from .urls import (default_feed_url, is_article_url, is_http_url, is_publication_url,
                   normalize_url, reads_url, resolve_url, url_host, url_path)

__all__ = [n for n in dir() if not n.startswith("_")]
