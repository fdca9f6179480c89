"""Recorded goldens that several tests read."""

# FIXED golden readings (new readings file) with recorded probabilities.
GOLDEN = [
    (298.1, 308.6, 1551.0, 42.8, 108.0, 1.0, 0.0),
    (299.2, 309.8, 1476.0, 38.9, 145.0, 1.0, 0.0),
    (300.5, 311.2, 1682.0, 51.2, 67.0, 0.8809791666666668, 0.11902083333333334),
    (297.8, 307.9, 1398.0, 35.7, 201.0, 0.912070344588124, 0.08792965541187593),
    (301.2, 312.1, 1728.0, 54.8, 89.0, 0.8666801360924684, 0.1333198639075317),
    (298.9, 309.5, 1523.0, 41.3, 156.0, 1.0, 0.0),
    (299.7, 310.3, 1605.0, 46.5, 92.0, 0.9951958333333333, 0.004804166666666667),
    (300.1, 310.8, 1567.0, 44.1, 134.0, 1.0, 0.0),
    (298.5, 308.9, 1489.0, 39.8, 178.0, 1.0, 0.0),
    (299.8, 310.5, 1634.0, 48.3, 112.0, 0.9951958333333333, 0.004804166666666667),
]
