"""Shapes of the records: comments, documents, and the fields that are dropped."""

from __future__ import annotations

from pyspark.sql import types as T

#: A comment as the stages need it. Epochs are text, as archives write them as int, float or string.
COMMENT = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "link_id", "author", "body", "created_utc", "subreddit", "permalink", "retrieved_on", "retrieved_utc")])
COMMENT_FIELDS = tuple(COMMENT.names)

#: The archive fields that the extract stage removes. ``quarantined`` isn't one of them.
DROPPED_FIELDS = """
all_awardings approved_at_utc approved_by archived associated_award author_created_utc author_flair_background_color
author_flair_css_class author_flair_richtext author_flair_template_id author_flair_text author_flair_text_color
author_flair_type author_fullname author_is_blocked author_patreon_flair author_premium awarders banned_at_utc banned_by
can_gild can_mod_post collapsed collapsed_because_crowd_control collapsed_reason collapsed_reason_code comment_type
controversiality created distinguished downs editable edited gilded gildings is_submitter likes locked _meta mod_note
mod_reason_by mod_reason_title mod_reports name no_follow num_reports parent_id removal_reason replies report_reasons
saved score score_hidden send_replies stickied subreddit_id subreddit_name_prefixed subreddit_type top_awarded_type
total_awards_received treatment_tags unrepliable_reason updated_on ups user_reports
""".split()
