"""Values both derivations of the test exports share (inputs, not logic under test)."""

# (source, medium, campaign); row event_id % 23.  Together they reach every channel.
TRAFFIC = [
    ("(direct)", "(none)", None),
    ("google", "cpc", "cross-network"),
    ("amazon", "cpc", "c1"),
    ("Google", "cpc", "brand"),
    ("facebook", "paid", "c2"),
    ("youtube", "ppc", "c3"),
    ("acme", "banner", "c4"),
    ("acme", "retargeting", "c5"),
    ("etsy", "referral", "c6"),
    ("twitter", "referral", "c7"),
    ("vimeo", "x", "c8"),
    ("bing", "organic", "c9"),
    ("acme", "referral", "c10"),
    ("acme", "email", "c11"),
    ("acme", "affiliate", "c12"),
    ("acme", "audio", "c13"),
    ("sms", "x", "c14"),
    ("firebase", "x", "c15"),
    ("acme", "x", "c16"),
    ("google", "cpm", "c17"),
    ("Google", "Organic", "c18"),
    ("acme", "x", "my shop"),
    (None, None, None),
]

# Text parameters without a rule of their own, with position 1, 2, ... deciding when they are absent.
TEXT_PARAMS = [
    "link_domain",
    "competition",
    "page_path",
    "page_title",
    "screen_name",
    "article_master_id",
    "article_child_id",
    "page_type",
    "event_category",
    "event_action",
    "match_id",
    "match_name",
    "event_label",
    "video_type",
    "team_id",
    "video_id",
    "article_master_title",
    "article_child_title",
    "video_title",
    "partners",
]

HIT_DIMENSIONS = [1, 4, 10, 14, 25, 30, 31, 35, 36, 37, 39, 40, 41, 42, 43, 44, 51, 53, 56, 105, 106]
# Given twice in some hits.
REPEATED_DIMENSIONS = [10, 14]

BUCKET_MICROS = 259_200_000_000
BUCKET_SECONDS = 259_200
ROUNDING_MICROS = 21_600_000_000
