"""DataFrame operators of the rule-mining job."""
