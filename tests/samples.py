"""Records that the tests share."""

import base64
import json

LEAD = {
    "companyName": "North Harbour Freight",
    "industry": "Logistics",
    "region": "Baltic",
    "opportunityType": "New Construction",
    "summary": "North Harbour Freight puts $20M into a second terminal at the port.",
    "potentialNeed": ["Construction Services", "Cranes"],
    "opportunityScore": 9,
    "keyQuote": "We will double our volumes.",
    "sourceURL": "https://example.com/news/1",
}
ARTICLE = {
    "clean_text": "An article.",
    "source_url": "https://example.com/news/1",
    "source_domain": "example.com",
}


def envelope(record) -> str:
    text = record if isinstance(record, str) else json.dumps(record)
    return base64.b64encode(text.encode()).decode()


def lead(**changes) -> dict:
    return {name: value for name, value in (LEAD | changes).items() if value is not ...}
