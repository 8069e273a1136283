"""Gene panels. Published marker lists that results depend on, in the order that breaks ties."""

from __future__ import annotations

# Fixed values.
CELL_TYPES = {
    "Tumor epithelial": ["EPCAM", "KRT7", "KRT8", "KRT18", "KRT19", "MUC1"],
    "T cell": ["CD3D", "CD3E", "TRAC", "CD4", "CD8A", "IL7R"],
    "NK cell": ["GNLY", "NKG7", "KLRD1", "NCAM1"],
    "B cell": ["CD79A", "CD79B", "MS4A1", "CD19"],
    "Myeloid/Macro": ["LYZ", "CD68", "CST3", "FCGR3A", "AIF1"],
    "Fibroblast": ["DCN", "LUM", "COL1A1", "COL3A1", "FAP"],
    "Endothelial": ["PECAM1", "VWF", "CDH5", "CLDN5"],
    "Plasma cell": ["IGHG1", "IGKC", "MZB1", "XBP1"],
    "Mast cell": ["TPSAB1", "TPSB2", "CPA3", "KIT"],
    "Dendritic cell": ["CD1C", "CLEC9A", "FCER1A", "IRF8"],
}

# S and G2/M panels of Tirosh et al. 2016.
S_PHASE = [
    "MCM5", "PCNA", "TYMS", "FEN1", "MCM2", "MCM4", "RRM1", "UNG", "GINS2", "MCM6", "CDCA7",
    "DTL", "PRIM1", "UHRF1", "MLF1IP", "HELLS", "RFC2", "RPA2", "NASP", "RAD51AP1", "GMNN", "WDR76",
    "SLBP", "CCNE2", "UBR7", "POLD3", "MSH2", "ATAD2", "RAD51", "RRM2", "CDC45", "CDC6", "EXO1",
    "TIPIN", "DSCC1", "BLM", "CASP8AP2", "USP1", "CLSPN", "POLA1", "CHAF1B", "BRIP1", "E2F8",
]
G2M_PHASE = [
    "HMGB2", "CDK1", "NUSAP1", "UBE2C", "BIRC5", "TPX2", "TOP2A", "NDC80", "CKS2", "NUF2", "CKS1B",
    "MKI67", "TMPO", "CENPF", "TACC3", "FAM64A", "SMC4", "CCNB2", "CKAP2L", "CKAP2", "AURKB", "BUB1",
    "KIF11", "ANP32E", "TUBB4B", "GTSE1", "KIF20B", "HJURP", "CDCA3", "HN1", "CDC20", "TTK", "CDC25C",
    "KIF2C", "RANGAP1", "NCAPD2", "DLGAP5", "CDCA2", "CDCA8", "ECT2", "KIF23", "HMMR", "AURKA", "PSRC1",
    "ANLN", "LBR", "CKAP5", "CENPE", "CTCF", "NEK2", "G2E3", "GAS2L3", "CBX5", "CENPA",
]

# Immune subtypes after Zheng 2017, Zhang 2018 and Tirosh 2016.
IMMUNE_SUBTYPES = {
    "CD4_naive": ["CCR7", "LEF1", "SELL", "TCF7", "IL7R"],
    "CD4_memory": ["IL7R", "S100A4", "ANXA1", "CCR6", "AQP3"],
    "Treg": ["FOXP3", "IL2RA", "CTLA4", "IKZF2", "TNFRSF18"],
    "Th1": ["TBX21", "IFNG", "CXCR3", "IL12RB2", "STAT4"],
    "Th2": ["GATA3", "IL4", "IL5", "IL13", "CCR4"],
    "Th17": ["RORC", "IL17A", "CCR6", "IL23R", "IL22"],
    "CD8_effector": ["CD8A", "GZMB", "PRF1", "NKG7", "GNLY", "IFNG"],
    "CD8_memory": ["CD8A", "IL7R", "GPR183", "SELL", "TCF7"],
    "CD8_exhausted": ["CD8A", "PDCD1", "LAG3", "HAVCR2", "TIGIT", "TOX", "CTLA4"],
    "NK_cytotoxic": ["NKG7", "GNLY", "KLRD1", "KLRF1", "NCAM1", "FCGR3A"],
    "Macro_M1": ["CD68", "NOS2", "IL1B", "TNF", "CXCL10", "CD80"],
    "Macro_M2": ["CD68", "CD163", "MRC1", "MSR1", "TGFB1", "IL10"],
    "cDC1": ["CLEC9A", "XCR1", "BATF3", "IRF8"],
    "cDC2": ["CD1C", "FCER1A", "CLEC10A", "CD1E"],
    "pDC": ["LILRA4", "IRF7", "TCF4", "CLEC4C"],
}
IMMUNE_STATES = {
    "exhaustion": ["LAG3", "HAVCR2", "TIGIT", "PDCD1", "CTLA4", "TOX", "TOX2", "ENTPD1"],
    "cytotoxicity": ["GZMA", "GZMB", "GZMK", "GZMH", "PRF1", "NKG7", "GNLY", "FASLG"],
    "activation": ["CD69", "CD38", "HLA-DRA", "ICOS", "TNFRSF9", "TNFRSF4"],
}
IMMUNE_PARENTS = ["T cell", "NK cell", "Myeloid/Macro", "Dendritic cell", "Mast cell", "B cell", "Plasma cell"]

# Microenvironment signatures after Rooney 2015, Ayers 2017 and Yoshihara 2013.
MICROENVIRONMENT = {
    "CYT": ["GZMA", "PRF1"],
    "TIS": ["CD27", "CD274", "CD276", "CD8A", "CMKLR1", "CXCL9", "CXCR6", "HLA-DQA1", "HLA-DRB1", "HLA-E", "IDO1", "LAG3", "NKG7", "PDCD1LG2", "PSMB10", "STAT1", "TIGIT", "TGFB1"],
    "IFNg": ["IFNG", "STAT1", "CCR5", "CXCL9", "CXCL10", "CXCL11", "IDO1", "PRF1", "GZMA", "HLA-DRA"],
    "immunosuppression": ["IDO1", "CD274", "PDCD1LG2", "HAVCR2", "LAG3", "TGFB1", "IL10", "VEGFA", "ARG1"],
    "immune_estimate": ["CD2", "CD3D", "CD3E", "CD3G", "CD8A", "CD19", "CD79A", "MS4A1", "LCK", "GZMB", "NKG7", "PRF1", "GNLY"],
    "stromal_estimate": ["DCN", "LUM", "COL1A1", "COL3A1", "COL5A1", "FAP", "ACTA2", "VIM", "FN1", "SPARC", "POSTN", "THY1"],
}
CHECKPOINTS = {"PD-1": "PDCD1", "PD-L1": "CD274", "PD-L2": "PDCD1LG2", "CTLA-4": "CTLA4", "LAG-3": "LAG3", "TIM-3": "HAVCR2", "TIGIT": "TIGIT", "VISTA": "VSIR", "IDO1": "IDO1", "B7-H3": "CD276"}

# Cancer signatures.
SIGNATURES = {
    "proliferation": ["MKI67", "TOP2A", "PCNA", "MCM2", "MCM6", "CDK1", "CCNB1", "CCNB2"],
    "apoptosis_resistance": ["BCL2", "BCL2L1", "MCL1", "BIRC5", "XIAP", "CFLAR"],
    "angiogenesis": ["VEGFA", "VEGFB", "FLT1", "KDR", "PECAM1", "ANGPT2", "NRP1"],
    "invasion_metastasis": ["MMP2", "MMP9", "MMP14", "SNAI1", "TWIST1", "VIM", "CDH2"],
    "EMT_mesenchymal": ["VIM", "CDH2", "FN1", "SNAI2", "ZEB1", "ZEB2", "TWIST1", "MMP2"],
    "EMT_epithelial": ["CDH1", "EPCAM", "KRT8", "KRT18", "KRT19", "CLDN4", "OCLN"],
    "stemness": ["POU5F1", "NANOG", "SOX2", "KLF4", "MYC", "LIN28A", "SALL4", "BMI1"],
    "hypoxia": ["VEGFA", "SLC2A1", "HK2", "LDHA", "PGK1", "CA9", "BNIP3", "ENO1"],
    "DDR": ["BRCA1", "BRCA2", "ATM", "ATR", "RAD51", "CHEK1", "CHEK2", "TP53"],
    "glycolysis": ["HK2", "PFKP", "PKM", "LDHA", "ENO1", "GAPDH", "TPI1", "ALDOA"],
}

# Transcription factors and targets.
REGULONS = {
    "TP53": ["CDKN1A", "MDM2", "BAX", "FAS", "GADD45A", "BBC3", "PMAIP1"],
    "MYC": ["NCL", "NPM1", "LDHA", "ENO1", "CDK4", "PCNA", "RAN"],
    "STAT1": ["IRF1", "GBP1", "ISG15", "CXCL10", "TAP1", "B2M"],
    "NFKB1": ["NFKBIA", "TNF", "IL6", "CXCL8", "CCL2", "ICAM1"],
    "HIF1A": ["VEGFA", "SLC2A1", "LDHA", "PGK1", "CA9", "BNIP3"],
    "SOX2": ["NANOG", "POU5F1", "SALL4", "BMI1", "KLF4"],
    "FOXP3": ["IL2RA", "CTLA4", "TNFRSF18", "IKZF2", "LRRC32"],
    "TBX21": ["IFNG", "CXCR3", "IL12RB2", "STAT4", "CCL3"],
    "GATA3": ["IL4", "IL5", "IL13", "CCR4", "STAT6"],
    "TWIST1": ["VIM", "CDH2", "SNAI1", "MMP2", "FN1"],
    "SNAI1": ["VIM", "CDH2", "MMP9", "FN1", "TWIST1"],
    "NKX2-1": ["SFTPA1", "SFTPB", "SFTPC", "SFTPD", "SCGB1A1"],
}

# Subset of the hallmark gene sets.
HALLMARKS = {
    "HALLMARK_TNFA_SIGNALING_VIA_NFKB": ["JUNB", "CXCL2", "ATF3", "NFKBIA", "TNFAIP3", "PTGS2", "CXCL1", "IER3", "CD83", "CCL20", "CXCL3", "MAFF", "NFKB2", "TNFAIP2"],
    "HALLMARK_HYPOXIA": ["PGK1", "LDHA", "ALDOA", "ENO1", "GAPDH", "TPI1", "PGAM1", "PKM", "GPI", "VEGFA", "SLC2A1", "HK2", "BNIP3", "CA9"],
    "HALLMARK_P53_PATHWAY": ["CDKN1A", "MDM2", "BAX", "FAS", "GADD45A", "SESN1", "TP53I3", "RRM2B", "DDB2", "FDXR", "PMAIP1", "BBC3", "ZMAT3", "BTG2"],
    "HALLMARK_EPITHELIAL_MESENCHYMAL_TRANSITION": ["VIM", "CDH2", "FN1", "SNAI2", "MMP2", "MMP3", "SPARC", "COL1A1", "COL3A1", "ACTA2", "TAGLN", "THY1", "LOX", "TWIST1"],
    "HALLMARK_INFLAMMATORY_RESPONSE": ["IL1B", "CXCL8", "CCL2", "CXCL10", "ICAM1", "IRF1", "SOCS3", "STAT1", "IL6", "CCL5", "CXCL11", "ISG15", "GBP1", "TAP1"],
    "HALLMARK_INTERFERON_GAMMA_RESPONSE": ["IRF1", "STAT1", "GBP1", "ISG15", "CXCL10", "CXCL11", "TAP1", "B2M", "HLA-A", "HLA-B", "HLA-C", "HLA-DRA", "CIITA", "IDO1"],
    "HALLMARK_OXIDATIVE_PHOSPHORYLATION": ["ATP5F1A", "ATP5F1B", "COX5A", "COX7C", "NDUFA1", "NDUFB8", "UQCRC1", "SDHA", "SDHB", "CYC1", "ATP5MC1", "NDUFS3"],
    "HALLMARK_MYC_TARGETS_V1": ["NCL", "NPM1", "LDHA", "ENO1", "CCT5", "RAN", "SRM", "NOP56", "HSPD1", "PHB", "PA2G4", "CDK4", "PCNA", "RRP1"],
    "HALLMARK_APOPTOSIS": ["CASP3", "CASP8", "BAX", "BCL2L11", "BID", "DIABLO", "CYCS", "TNFRSF10B", "BIRC3", "CFLAR", "FAS", "LMNA", "PMAIP1"],
    "HALLMARK_ANGIOGENESIS": ["VEGFA", "FLT1", "KDR", "PECAM1", "CDH5", "ANGPT2", "NRP1", "FGF2", "PDGFRB", "TEK", "THBS1", "COL4A1"],
}

# Ligand and receptor pairs.
LIGAND_RECEPTOR = [
    ("CD274", "PDCD1"), ("CD80", "CTLA4"), ("CXCL12", "CXCR4"), ("CCL2", "CCR2"), ("VEGFA", "FLT1"), ("VEGFA", "KDR"), ("TGFB1", "TGFBR2"), ("TNF", "TNFRSF1A"), ("FAS", "FASLG"),
    ("HGF", "MET"), ("PDGFA", "PDGFRA"), ("DLL1", "NOTCH1"), ("WNT5A", "FZD5"), ("SPP1", "CD44"), ("CDH1", "CDH1"), ("CXCL10", "CXCR3"), ("IL6", "IL6R"), ("CCL5", "CCR5"),
]

# Chromosomes that copy numbers are inferred on.
CHROMOSOMES = [*map(str, range(1, 23)), "X", "Y"]
