"""DataFrame operators: ledgers, people, domains, patterns, decisions, inboxes, crawls."""
