"""Operators for preparing training text: secrets, chat layouts, toxicity, personal data, quality, urls, copies, mixing, leaks."""
