"""Published totals used as golden data."""

# Total loss and victims per month, 2021-01 onwards, and per year.
MONTHLY = [
    (12894119.87, 4411),
    (27042043.27, 5055),
    (17017937.67, 6111),
    (22120277.22, 4711),
    (19401051.74, 4348),
    (19796860.95, 4633),
    (21723251.47, 4525),
    (21036153.60, 4211),
    (28828754.70, 3739),
    (33303325.59, 3661),
    (41681604.34, 3673),
    (44625562.72, 3754),
    (31830657.21, 4045),
    (36026148.84, 3300),
    (43628771.24, 4432),
    (36479561.04, 4578),
    (38666778.10, 4548),
    (30129928.36, 4158),
    (28081496.50, 3854),
    (31819744.13, 3955),
    (31265847.37, 3526),
    (49056937.23, 3363),
    (54742651.70, 3851),
    (32626793.71, 3941),
    (37131808.59, 3523),
    (43427005.65, 3184),
    (41154898.02, 3684),
    (33938067.54, 1847),
    (51638993.92, 3138),
    (48023798.31, 3281),
    (32056347.83, 3192),
    (43304947.83, 2910),
    (43260336.17, 2904),
    (41244752.98, 2846),
    (39030197.87, 2530),
    (43028135.00, 2707),
    (34450108.75, 2657),
    (34808929.03, 2481),
    (31588149.46, 2246),
    (58621029.61, 2657),
    (34797478.01, 2651),
    (52432829.07, 2368),
    (42392995.49, 2320),
    (33964495.00, 2706),
    (48048048.80, 2568),
    (50384253.87, 2572),
    (61326767.95, 2511),
    (41473889.66, 2516),
    (34128397.82, 2579),
    (43571016.61, 2272),
    (52699995.85, 2876),
    (51211159.52, 2406),
    (44744572.96, 2238),
    (53637742.52, 1922),
    (71739167.57, 1952),
    (53701722.27, 1687),
    (33614292.80, 1332),
]
YEARLY = {
    2021: (309470943.14, 52832),
    2022: (444355315.43, 47551),
    2023: (497239289.71, 35746),
    2024: (524288974.70, 30253),
    2025: (439048067.92, 19264),
}
