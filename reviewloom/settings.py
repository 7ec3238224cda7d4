"""Fixed values and tunable defaults shared by the operators.

Everything here is data: labels, thresholds, word lists, column lists and text
templates.  Operators take them as parameters and use these as defaults.
"""

from __future__ import annotations

# --- Fixed values: sentiment labels, in id order 0, 1, 2 -------------------
SENTIMENT_LABELS = ("negative", "neutral", "positive")

SENTIMENT_ALIASES = {
    "label_0": "negative",
    "label_1": "neutral",
    "label_2": "positive",
    "0": "negative",
    "1": "neutral",
    "2": "positive",
}

UNCATEGORISED = "General / uncategorized"

# --- Fixed values: raw file columns ----------------------------------------
RAW_TO_CLEAN_NAMES = {
    "name": "product_name",
    "brand": "brand",
    "categories": "categories",
    "primaryCategories": "primary_categories",
    "reviews.title": "review_title",
    "reviews.text": "review_text",
    "reviews.rating": "rating",
    "reviews.date": "review_date",
}

UNUSED_RAW_COLUMNS = (
    "reviews.username",
    "reviews.userCity",
    "reviews.userProvince",
    "reviews.didPurchase",
    "reviews.id",
    "id",
    "keys",
    "manufacturer",
    "reviews.sourceURLs",
    "sourceURLs",
    "reviews.dateAdded",
    "dateAdded",
    "dateUpdated",
    "reviews.dateSeen",
    "imageURLs",
    "manufacturerNumber",
    "reviews.doRecommend",
    "reviews.numHelpful",
)

DATE_COLUMNS = (
    "review_date",
    "review_date_added",
    "review_date_seen",
    "dateAdded",
    "dateUpdated",
)

RAW_REQUIRED_COLUMNS = ("reviews.text", "reviews.rating")
CLEAN_REQUIRED_COLUMNS = ("review_text", "rating", "sentiment_label")
TRAINING_REQUIRED_COLUMNS = ("classical_text", "sentiment_label")
INSIGHT_REQUIRED_COLUMNS = ("review_text", "cluster_id", "topic_name")
SENTIMENT_COLUMN_CANDIDATES = ("predicted_sentiment", "sentiment_label")

# --- Fixed values: word lists ----------------------------------------------
# The common English list of 179 words used for classical text features.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your
    yours yourself yourselves he him his himself she she's her hers herself it
    it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after
    above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don
    don't should should've now d ll m o re ve y ain aren aren't couldn couldn't
    didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't
    ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
    shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

NEGATION_WORDS = ("no", "nor", "not")

DOMAIN_STOP_WORDS = (
    "star", "stars", "rating", "ratings", "rated", "one", "two", "three", "four", "five",
    "review", "reviews", "amazon", "product", "products", "item", "items", "purchase",
    "purchased", "order", "ordered", "buy", "bought", "price", "seller",
)

GENERIC_TERMS = (
    "great", "good", "love", "loved", "nice", "well", "best", "excellent", "product",
    "products", "price", "buy", "bought", "use", "used", "using", "work", "works", "worked",
    "easy", "get", "got", "really", "would", "like",
)

# Categories and the words that point to them; the position breaks ties last.
TOPIC_TAXONOMY = (
    (
        "Fire Tablets",
        (
            "tablet", "tablets", "kids", "kid",
        ),
    ),
    (
        "Kindle E-Readers & Books",
        (
            "kindle", "book", "books", "read", "reading", "reader", "ebook", "paperwhite",
            "page", "pages",
        ),
    ),
    (
        "Fire TV & Streaming",
        (
            "tv", "stick", "streaming", "remote", "roku", "channel", "channels",
        ),
    ),
    (
        "Echo & Alexa Devices",
        (
            "echo", "alexa", "dot", "speaker", "music", "smart", "home",
        ),
    ),
    (
        "Batteries",
        (
            "battery", "batteries", "aa", "aaa", "alkaline", "rayovac", "charge", "charged",
            "duracell",
        ),
    ),
    (
        "Ease of Use",
        (
            "setup", "install", "installation", "instructions", "simple", "intuitive",
        ),
    ),
)

# Words that the word tokeniser splits in two, as (first part, second part).
TOKEN_SPLITS = (
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
)

# Noun suffix rules, applied in this order to lowercase words when no lemma
# dictionary is given: (ending with its left context, replacement).  The context is looked
# at behind the ending, so only where there is one, not at every character.
NOUN_SUFFIX_RULES = (
    (r"ies\b(?<=[a-z]{2}ies)", "y"),
    (r"es\b(?<=[a-z](?:ch|sh|ss|x|z)es)", ""),
    (r"men\b", "man"),
    (r"s\b(?<=[a-z][a-hj-rtv-z]s)", ""),
)

CONTRAST_WORDS = ("but", "however", "although", "though", "yet", "except")

# --- Fixed values: vectoriser and topic model defaults -----------------------------------
RANDOM_SEED = 42
TOPIC_VOCABULARY = {"max_features": 10_000, "min_df": 5, "max_df": 0.85}
CLASSIFIER_VOCABULARY = {"max_features": 30_000, "min_df": 2, "max_df": 0.95}
SVD_COMPONENTS = 100
N_CLUSTERS = 6
CLUSTER_COUNTS = tuple(range(2, 11))
KMEANS_RESTARTS = 20
SILHOUETTE_SAMPLE = 10_000
TOP_TERMS = 12
NAMING_TERMS = 8
REVIEWS_PER_CLUSTER = 5
MIN_CONTENT_TOKENS = 3
GENERIC_SHARE = 0.6

# --- Fixed values: summary, hook and recommendation thresholds -------------
CRITICAL_NEGATIVE = 0.60
ATTENTION_NEGATIVE = 0.35
STRONG_POSITIVE = 0.60
STRONG_MAX_NEGATIVE = 0.15
HOOK_LIKED_PERCENT = 95
OPPORTUNITY_POSITIVE = 0.70
HIGH_PRIORITY_NEGATIVE = 0.50
MEDIUM_PRIORITY_NEGATIVE = 0.35
POSITIVE_TEMPLATE_NEGATIVE = 0.20
PRIORITIES = ("High", "Medium", "Low")
HIGH_CONFIDENCE = 0.80

# --- Fixed values: recommendation texts, keyword -> (action, rationale) ----
# Ordered: the first keyword contained in the topic name wins.
ACTION_TEMPLATES = (
    (
        "Battery",
        "Investigate battery life complaints and review hardware quality.",
        "Battery-related issues frequently lead to poor customer satisfaction.",
    ),
    (
        "Echo",
        "Review Alexa responsiveness, connectivity, and firmware stability.",
        "Voice assistant reliability has a direct impact on daily usage.",
    ),
    (
        "Kindle",
        "Improve reading experience, software stability, and synchronization.",
        "Reading interruptions reduce perceived product quality.",
    ),
    (
        "Fire TV",
        "Optimize streaming performance and application responsiveness.",
        "Entertainment devices are highly sensitive to lag and crashes.",
    ),
    (
        "Fire Tablet",
        "Focus on device speed, durability, and battery optimisation.",
        "Tablet users report performance issues affecting everyday usage.",
    ),
    (
        "General",
        "Perform deeper qualitative analysis to identify recurring pain points.",
        "This cluster combines reviews without a dominant theme.",
    ),
)
POSITIVE_TEMPLATE = (
    "Maintain the current customer experience while continuing to monitor future reviews.",
    "Customers generally report positive experiences in this topic.",
)
FALLBACK_TEMPLATE = (
    "Investigate recurring customer concerns and prioritize product improvements.",
    "Customer feedback indicates opportunities for quality improvements.",
)

# --- Fixed values: column candidates, in order of preference ---------------
TOPIC_ID_CANDIDATES = ("topic_id", "cluster", "cluster_id")
TOPIC_NAME_CANDIDATES = ("topic", "topic_name", "cluster_name", "label")
TOPIC_SIZE_CANDIDATES = ("topic_size", "review_count", "count", "size")
CLUSTER_SIZE_CANDIDATES = ("review_count", "size", "count", "n_reviews", "n")
POSITIVE_CANDIDATES = (
    "positive_ratio",
    "positive_percentage",
    "positive_share",
    "positive",
)
NEGATIVE_CANDIDATES = (
    "negative_ratio",
    "negative_percentage",
    "negative_share",
    "negative",
)

# --- Fixed values: tracking tables -----------------------------------------
TRACKING_COLUMNS = (
    ("model_id", "string"),
    ("model_name", "string"),
    ("model_family", "string"),
    ("features", "string"),
    ("preprocessing", "string"),
    ("algorithm", "string"),
    ("pretrained_model", "string"),
    ("dataset", "string"),
    ("training_rows", "bigint"),
    ("validation_rows", "bigint"),
    ("train_accuracy", "double"),
    ("validation_accuracy", "double"),
    ("macro_precision", "double"),
    ("macro_recall", "double"),
    ("macro_f1", "double"),
    ("weighted_f1", "double"),
    ("training_time_seconds", "double"),
    ("inference_time_ms", "double"),
    ("epochs", "int"),
    ("batch_size", "int"),
    ("learning_rate", "double"),
    ("max_length", "int"),
    ("hyperparameters", "string"),
    ("artifact_path", "string"),
    ("timestamp_utc", "string"),
)
ABLATION_COLUMNS = (
    ("experiment_id", "string"),
    ("model_name", "string"),
    ("changed_factor", "string"),
    ("variant", "string"),
    ("macro_f1", "double"),
    ("neutral_f1", "double"),
    ("negative_recall", "double"),
    ("training_time_seconds", "double"),
    ("inference_ms", "double"),
    ("notes", "string"),
)

# Name shown at the start of generated sentences and report titles.
REPORT_BRAND = "Reviewloom"
