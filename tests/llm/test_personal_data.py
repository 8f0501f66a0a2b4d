"""Identifiers that no fixed pattern matches, and patterns that only strings found lead to."""

from ledgerloom.llm import personal_data
from tests.llm.samples import documents


def test_strings_by_shape_and_patterns_by_strings_found(spark):
    known = [f"please write to user{k}@host{k}.org soon" for k in range(40)] + [f"our desk answers +1 (555) 010-{1000 + 7 * k} daily" for k in range(40)]
    unseen = {
        "email": ["admin@localhost", "jane(at)host.org", "joe (at) host.org"],
        "phone": ["(555) 010 2000", "030 1234 5678"],
    }
    texts = known + [f"please write to {x} soon" for x in unseen["email"]] + [f"our desk answers {x} daily" for x in unseen["phone"]]
    # The second context is met by no seed: only strings found in the first one lead to it.
    bridge = [f"desk{k}@local" for k in range(8)]
    texts += [f"please write to {x} soon" for x in bridge] + [f"inbox named {x} is full" for x in [*bridge, "last@corner"]]
    texts += [f"order number {10000 + k} was shipped" for k in range(40)] + ["follow @handle"]
    rows = {r.doc_id: r.spans for r in personal_data.personal_data(documents(spark, texts)).collect()}
    for k, text in enumerate(texts[80:], 80):
        wanted = [(kind, x) for kind, xs in {**unseen, "email": [*unseen["email"], *bridge, "last@corner"]}.items() for x in xs if x in text]
        assert rows[k] == ",".join(f"{kind}:{text.index(x)}:{text.index(x) + len(x)}" for kind, x in wanted), text
