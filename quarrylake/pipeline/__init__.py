"""Layers of a network's data: from archived rows to resolved people, histories, links, a star schema and its checks."""
