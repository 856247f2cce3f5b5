"""Fixed values of the lead-scoring contract, and the parameters that go with them."""

# The configured sources of one ingestion cycle.
SOURCES = (
    ("https://www.bloomberg.com/", "Scrape"),
    ("https://techcrunch.com/", "Scrape"),
    ("https://www.wired.com/", "Scrape"),
    ("https://hbr.org/", "Scrape"),
    ("https://www.forbes.com/", "Scrape"),
    ("https://www.wsj.com/", "Scrape"),
    ("https://www.trendhunter.com/", "Scrape"),
    ("https://explodingtopics.com/", "Scrape"),
    ("https://www.wipo.int/global_innovation_index/en/", "Scrape"),
    ("https://site.financialmodelingprep.com/developer/docs", "API"),
    ("https://www.cognism.com/api", "API"),
    ("https://coresignal.com/developers/api-documentation", "API"),
    ("https://platform.openai.com/docs/api-reference", "API"),
    ("https://cloud.google.com/apis/docs/overview", "API"),
)

# Relevance keywords, spelled as configured (they are matched as they stand).
KEYWORDS = (
    "business",
    "finance",
    "tech",
    "gcp",
    "cyptocurrency",
    "trading",
    "investing",
    "stocks",
    "startups",
    "venture capital",
    "ai",
    "machine learning",
    "blockchain",
    "cloud computing",
    "data science",
    "economics",
    "marketing",
    "entrepreneurship",
    "innovation",
    "product management",
    "leadership",
    "strategy",
    "digital transformation",
)

# Source reputation.
TRUSTED_HOSTS = ("reuters.com", "bloomberg.com")
BLOCKED_HOSTS = ("my-sensational-blog.net",)
TRUSTED_SCORE = 100
BLOCKED_SCORE = 0
DEFAULT_SCORE = 85

# Texts of the failed business rules.
RULE_CONSTRUCTION = (
    "If opportunityType is 'New Construction', then potentialNeed must include "
    "'Construction Services'."
)
RULE_TECHNOLOGY = (
    "The opportunityScore must be greater than 7 if the industry is 'Technology'."
)
RULE_SUMMARY = "The summary must be at least 50 characters long."
TOTAL_RULES = 20

# Decision thresholds.
APPROVE_ABOVE = 90
REJECT_BELOW = 70

# Fixed value: an investment figure in a summary.
INVESTMENT_PATTERN = r"\$[0-9]+M"

# Names of the stage tables.
STAGES = (
    "source-to-fetch",
    "article-to-filter",
    "article-to-analyze",
    "external-verification",
    "internal-qc",
    "decision-engine-queue",
    "final-analysis",
    "final-leads",
)

# Conditions of the business rules and of the consistency check.
CONSTRUCTION_TYPE = "New Construction"
CONSTRUCTION_NEED = "Construction Services"
TECHNOLOGY_INDUSTRY = "Technology"
TECHNOLOGY_SCORE_ABOVE = 7
SUMMARY_LENGTH = 50
EXPANSION_WORD = "expansion"
DOWNSIZING_TYPE = "Downsizing"

# What each failed check takes off the quality score.
RULE_PENALTY = 10
CONSISTENCY_PENALTY = 20
TONE_PENALTY = 10

# Answers to a record. The message of an invalid one ends with its error.
REVIEW_MESSAGE = "Analysis for {company} requires manual review."
PUBLISHED_MESSAGE = "Published final analysis for {company} with decision: {decision}"
INVALID_MESSAGE = "Invalid enriched analysis format: {error}"

# Texts of an alert in the order of its parts.
ALERT_LINE = "🔥 New Opportunity Hunted: {company}"
ALERT_HEADER = "🚀 {company}"
ALERT_INDUSTRY = "*Industry:*\n{industry}"
ALERT_REGION = "*Region:*\n{region}"
ALERT_OPPORTUNITY = "*Opportunity:* {summary}"
ALERT_NEEDS = "*Potential Needs:*\n• {needs}"
ALERT_NEED_SEPARATOR = "\n• "
ALERT_SOURCE = "Source: <{url}|Click to view>"
ALERT_CONFIDENCE = " | Confidence: *{confidence}%*"

# Fixed value: title of a review form without a company.
NO_COMPANY = "No Company Name"

CYCLE = "30 minutes"
REVIEW_WINDOW = "60 seconds"

# Parameters of ours.
BROADCAST_ROWS = 100_000   # most rows a side may have to be broadcast

# Words that make a summary sound sensational, for the optional tone check.
SENSATIONAL_WORDS = (
    "amazing", "bombshell", "disaster", "incredible", "insane", "miracle",
    "outrageous", "scandal", "shocking", "stunning", "unbelievable", "worst",
)
TONE_LIMIT = 0.1

# The article text goes where the marker stands.
ARTICLE_MARKER = "{{ARTICLE_TEXT}}"
PROMPT_TEMPLATE = """Read the news article below as a business-to-business sales analyst.
Answer with one JSON object only, without any text around it. Its fields are:

companyName (text), industry (text), region (text), opportunityType (text, such as
New Construction, Expansion or Merger), summary (text), potentialNeed (list of text),
opportunityScore (whole number from 1 to 10), keyQuote (text), sourceURL (text).

Article:

{{ARTICLE_TEXT}}
"""
