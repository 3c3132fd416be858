"""The three jobs: sales report, import, cart rules."""
