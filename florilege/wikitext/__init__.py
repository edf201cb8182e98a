"""Reader of wiki markup: pages to sections, blocks and rich text. Syntax only; what things mean is decided in SQL."""
