"""What the library computes: cleaning, integrity, facts, reports, faults."""
