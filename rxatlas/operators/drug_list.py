"""Default drug/illness dimension.

Fixed values that must equal the reference's shipped list: illness, tags,
medication names, in their natural order (blanks after some names kept as
given; loading trims them).
"""

DEFAULT_ILLNESSES = [
    ("Depression", ["Loneliness"], [
        "Fluoxetine", "Citalopram", "Paroxetine", "Sertraline", "Dapoxetine", "Escitalopram",
        "Fluvoxamine", "Duloxetine", "Venlafaxine", "Mirtazapine", "Amitriptyline",
        "Clomipramine", "Imipramine", "Lofepramine", "Nortriptyline", "Prozac", "Cipramil",
        "Seroxat", "Lustral", "Priligy", "Cipralex", "Faverin", "Cymbalta", "Efexor", "Zispin",
        "Tryptizol", "Anafranil", "Tofranil", "Gamanil", "Allegron", "Yentreve", "Oxactin"]),
    ("Alzheimers", ["Loneliness"], [
        "Donepezil", "Rivastigmine", "Galantamine", "Aricept", "Exelon", "Reminyl"]),
    ("Blood Pressure", ["Loneliness"], [
        "Enalapril", "Lisinopril", "Perindopril", "Ramipril", "Candesartan", "Irbesartan ",
        "Losartan ", "Valsartan ", "Olmesartan", "Amlodipine", "Felodipine ", "Nifedipine"]),
    ("Hypertension", [], [
        "Olmesartan", "Verapamil", "Perindopril", "Losartan", "Nifedipine", "Enalapril",
        "Candesarta", "Amlodipine", "Lisinopril", "Irbesartan", "Felodipine", "Ramipril",
        "Valsartan", "Diltiazem"]),
    ("Diabetes", [], ["Metformin"]),
    ("Cardiovascular disease", [], [
        "Atorvastatin", "Fluvastatin", "Pravastatin", "Rosuvastatin", "Simvastatin", "Lipitor",
        "Lescol", "Lipostat", "Crestor", "Zocor"]),
    ("insomnia", ["Loneliness"], ["Zopiclone"]),
    ("addiction", [], ["Methadone"]),
    ("social anxiety", ["Loneliness"], ["Escitalopram", "Sertraline"]),
]
