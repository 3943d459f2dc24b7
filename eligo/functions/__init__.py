"""Column functions: text segmentation, lenient parsing, rule trees."""
